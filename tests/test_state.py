"""Bounded state, manifests and numbers that stay, over many batches with restarts and replays."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from reviewlens.operators import relate
from reviewlens.sources import sinks
from reviewlens.streaming import flows, state

START = dt.datetime(2024, 1, 1)
SCHEMA = "key string, page int, place int, at timestamp"


def put(spark, folder, number, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{number:03d}")


def opened(spark, folder, schema=SCHEMA):
    return flows.file_stream(spark, f"{folder}/*", spark.createDataFrame([], schema).schema, max_files=1)


def day(n):
    return START + dt.timedelta(days=n)


def test_dedup_state_stays_bounded_over_20_batches(spark, tmp_path):
    folder = tmp_path / "in"
    for n in range(20):
        # ten new keys a day, one that comes every day, and one late row from the start
        rows = [(f"{n}-{i}", 1, i, day(n)) for i in range(10)] + [("daily", 1, n, day(n))] + ([("late", 1, 0, day(0))] if n > 5 else [])
        put(spark, folder, n, rows)
    unique = state.dedup_bounded(opened(spark, folder), ["key"], "at", "2 days")
    query = flows.to_files(unique, str(tmp_path / "out"), str(tmp_path / "c"))
    query.awaitTermination()
    kept = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert max(kept) <= 70 and kept[-1] <= 70
    got = [r.key for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(k for k in got if k[0].isdigit()) == sorted(f"{n}-{i}" for n in range(20) for i in range(10))
    assert "late" not in got and 1 < got.count("daily") <= 5


def test_gathered_pages_match_the_batch_over_20_batches_with_restarts(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "c")
    # three pages a key; four groups of keys, five days apart, so that the last groups come when the first are forgotten
    rows = {n: [] for n in range(20)}
    for group in range(4):
        for k in range(6):
            for page in (1, 2, 3):
                if k == 5 and page > 1:
                    continue  # nothing after its first page
                size = [0, 3, 8, 20, 6, 4][k] if page != 2 else k
                rows[group * 5 + page - 1] += [(f"g{group}k{k}", page, i, day(group * 5 + page)) for i in range(size)]
    for n in range(20):
        rows[n].append(("clock", 9, n, day(n + 1)))

    def run():
        gathered = state.gather_pages(opened(spark, folder), ["key"], "page", ["place"], "at", idle_hours=36)
        query = flows.to_files(gathered, out, checkpoint)
        query.awaitTermination()
        return query

    for n in range(20):
        put(spark, folder, n, rows[n])
        if n in (1, 8, 12):
            run()
    last = run()
    every = spark.createDataFrame([r for n in range(20) for r in rows[n]], SCHEMA)
    want = relate.accumulate_pages(every, ["key"], "page", ["place"])
    got = spark.read.parquet(out)
    assert got.exceptAll(want).count() == 0
    missing = {r.key[:2] for r in want.exceptAll(got).collect()}
    assert missing <= {"g3"}  # only the last group may still be waiting
    assert last.recentProgress[-1].stateOperators[0].numRowsTotal < 60


@pytest.fixture
def exported(spark, tmp_path):
    """A keyed table with JSON and CSV exports after two batches."""
    folder, target = tmp_path / "in", str(tmp_path / "t")
    sink = lambda kind, write: lambda batch_id: lambda df: write(df, str(tmp_path / kind / f"{flows.BATCH}={batch_id}"))

    def run(sinks_=None):
        made = sinks_ or [sink("json", sinks.write_json), sink("csv", sinks.write_csv)]
        flows.upsert_stream(opened(spark, folder), target, ["key"], ["place"], str(tmp_path / "c"), made).awaitTermination()

    def views():
        table = flows.read_upserted(spark, target, ["key"], ["place"])
        json = flows.read_committed(spark, target, str(tmp_path / "json"), "json")
        csv = flows.read_committed(spark, target, str(tmp_path / "csv"), "csv", header=True)
        return [sorted((r.key, int(r.place)) for r in df.collect()) for df in (table, json, csv)]

    put(spark, folder, 1, [("a", 1, 1, day(1)), ("b", 1, 1, day(1))])
    run()
    put(spark, folder, 2, [("a", 1, 2, day(2))])
    run()
    return folder, target, run, views


def test_a_half_written_batch_is_not_read(spark, exported, tmp_path):
    folder, target, run, views = exported
    want = [[("a", 2), ("b", 1)], [("a", 1), ("a", 2), ("b", 1)], [("a", 1), ("a", 2), ("b", 1)]]
    assert views() == want
    put(spark, folder, 3, [("b", 1, 9, day(3)), ("c", 1, 1, day(3))])

    def fails(batch_id):
        def write(df):
            raise RuntimeError("disk full")

        return write

    whole = lambda batch_id: lambda df: sinks.write_json(df, str(tmp_path / "json" / f"{flows.BATCH}={batch_id}"))
    with pytest.raises(Exception, match="disk full"):
        run([whole, fails])
    assert views() == want  # the table and the JSON hold the batch already, the CSV does not
    run()
    assert views() == [
        [("a", 2), ("b", 9), ("c", 1)], [("a", 1), ("a", 2), ("b", 1), ("b", 9), ("c", 1)], [("a", 1), ("a", 2), ("b", 1), ("b", 9), ("c", 1)]
    ]


def test_numbers_stay_when_new_keys_come_and_batches_repeat(spark, tmp_path):
    ids = str(tmp_path / "ids")
    frame = lambda *keys: spark.createDataFrame([(k,) for k in keys], "key string")
    numbers = lambda df: {r.key: r.id for r in df.collect()}
    first = numbers(flows.number_keys(frame("m", "c", None, "m"), 0, ids, "key", "id"))
    assert first == {"c": 1, "m": 2, None: None}
    second = numbers(flows.number_keys(frame("a", "m", "z"), 1, ids, "key", "id"))
    assert second == {"a": 3, "m": 2, "z": 4}
    assert numbers(flows.number_keys(frame("a", "m", "z"), 1, ids, "key", "id")) == second
    assert numbers(flows.number_keys(frame("m", "c", None, "m"), 0, ids, "key", "id")) == first


def test_upsert_replaces_only_the_parts_it_touches(spark, tmp_path):
    path, schema = tmp_path / "table", "key string, other string, o int"
    rows = [(f"k{i}", "x", 1) for i in range(200)] + [(None, "n", 1), (None, "m", 1)]
    sinks.upsert_table(spark.createDataFrame(rows, schema), str(path), ["key"], ["o"], parts=16)
    files = lambda: {str(f): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    before = files()
    sinks.upsert_table(spark.createDataFrame([("k7", "y", 2), ("k7", "z", 3), ("k7", "w", 1)], schema), str(path), ["key"], ["o"], parts=16)
    after = files()
    changed = {f.rsplit("/", 2)[1] for f in before.keys() ^ after.keys()}
    assert len(changed) == 1 and all(after[f] == t for f, t in before.items() if f.rsplit("/", 2)[1] not in changed)
    got = {(r.key, r.other) for r in sinks.read_upserted_table(spark, str(path)).collect()}
    assert got == {(k, "z" if k == "k7" else o) for k, o, _ in rows}
    sinks.upsert_table(spark.createDataFrame([], schema), str(path), ["key"], ["o"], parts=16)
    sinks.upsert_table(spark.createDataFrame([(None, "n", 1)], schema), str(path), ["key"], ["o"], parts=16)
    assert sinks.read_upserted_table(spark, str(path)).where(F.col("key").isNull()).count() == 3


def test_pages_are_gathered_in_a_session_with_another_state_store(spark, tmp_path):
    provider = "spark.sql.streaming.stateStore.providerClass"
    other = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    before = spark.conf.get(provider)
    for n in range(2):
        put(spark, tmp_path / "in", n, [("a", n + 1, i, day(n + 1)) for i in range(10)])
    try:
        spark.conf.set(provider, other)
        gathered = state.gather_pages(opened(spark, tmp_path / "in"), ["key"], "page", ["place"], "at", idle_hours=36)
        flows.to_files(gathered, str(tmp_path / "out"), str(tmp_path / "c"), state.GATHER_SETTINGS).awaitTermination()
        assert spark.conf.get(provider) == other
    finally:
        spark.conf.set(provider, before)
    got = sorted((r.page, r.place) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(1, i) for i in range(10)] + [(2, i) for i in range(5)]


def test_a_delivery_is_written_by_all_tasks_and_taken_as_one_batch(spark, tmp_path):
    from reviewlens.registry.flows import _arrived, _deliver

    rows = spark.range(400, numPartitions=4).withColumn("part", F.col("id") % 3)
    folder, batches = str(tmp_path / "in"), []

    def run():
        def step(batch, number):
            files = batch.select(F.input_file_name()).distinct().count()
            batches.append((number, files, sorted(r.part for r in batch.select("part").distinct().collect()), batch.count()))

        query = _arrived(rows, folder).writeStream.foreachBatch(step).option("checkpointLocation", str(tmp_path / "c"))
        query.trigger(availableNow=True).start().awaitTermination()

    _deliver(rows, folder, F.col("part"), range(3), run)
    assert batches == [(0, 4, [0], 134), (1, 4, [1], 133), (2, 4, [2], 133)]


def test_gathered_pages_keep_nulls_and_large_numbers(spark, tmp_path):
    schema = "key string, page int, place long, at timestamp, seen timestamp"
    large = (1 << 60) + 1
    put(spark, tmp_path / "in", 0, [("a", 1, None, day(1), None), ("a", 1, large, day(1), day(0)), ("a", 1, 2, day(1), None)], schema)
    put(spark, tmp_path / "in", 1, [("a", 2, large + 2, day(2), None), ("a", 3, None, day(2), None)], schema)
    gathered = state.gather_pages(opened(spark, tmp_path / "in", schema), ["key"], "page", ["place"], "at", idle_hours=36, cap=3)
    flows.to_files(gathered, str(tmp_path / "out"), str(tmp_path / "c"), state.GATHER_SETTINGS).awaitTermination()
    got = [(r.page, r.place, r.seen) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert got == [(1, 2, None), (1, large, day(0)), (1, None, None)]
