import pytest
from pyspark.sql import functions as F

from reviewlens.operators import relate
from reviewlens.sources import sinks
from reviewlens.streaming import flows

ITEMS = "link string, o int, title string, rating string"


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


@pytest.fixture
def items(spark, tmp_path):
    folder = tmp_path / "in"
    write(spark, folder, "1", [("a", 1, "x", "9"), ("b", 1, "y", "8"), ("a", 2, "x2", "9")], ITEMS)
    return folder


def stream(spark, folder, schema=ITEMS):
    from pyspark.sql.types import _parse_datatype_string

    return flows.file_stream(spark, f"{folder}/*", _parse_datatype_string(schema) if isinstance(schema, str) else schema, max_files=1)


def test_upsert_over_batches_and_replay(spark, items, tmp_path):
    target, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    run = lambda: flows.upsert_stream(stream(spark, items), target, ["link"], ["o"], checkpoint).awaitTermination()
    run()
    write(spark, items, "2", [("a", 1, None, "7"), ("c", 1, "z", "6")], ITEMS)
    run()
    got = flows.read_upserted(spark, target, ["link"], ["o"])
    want = {("a", None, "7"), ("b", "y", "8"), ("c", "z", "6")}
    assert {(r.link, r.title, r.rating) for r in got.collect()} == want
    # The last batch once more, as after a crash before its commit.
    replay = spark.createDataFrame([("a", 1, None, "7"), ("c", 1, "z", "6")], ITEMS)
    flows._store(relate.keep_last(replay, ["link"], ["o"]), target, 1)
    assert {(r.link, r.title, r.rating) for r in flows.read_upserted(spark, target, ["link"], ["o"]).collect()} == want
    folded = str(tmp_path / "folded")
    flows.compact(flows.read_upserted(spark, target, ["link"], ["o"]), folded)
    assert {(r.link, r.title, r.rating) for r in flows.read_upserted(spark, folded, ["link"], ["o"]).collect()} == want


def test_sinks_get_every_row_in_order(spark, items, tmp_path):
    order = []

    def sink(name):
        def for_batch(batch_id):
            def write_rows(df):
                order.append((name, df.count()))
                sinks.write_json(df, str(tmp_path / name / str(batch_id)))

            return write_rows

        return for_batch

    flows.upsert_stream(
        stream(spark, items), str(tmp_path / "t"), ["link"], ["o"], str(tmp_path / "c"), [sink("json"), sink("csv")]
    ).awaitTermination()
    assert order == [("json", 3), ("csv", 3)]


@pytest.mark.parametrize("spread", [False, True])
def test_dedup_over_batches(spark, items, tmp_path, spread):
    def run():
        df = flows.dedup_stream(stream(spark, items), ["link"], spread=F.col("o") if spread else None).select("link")
        flows.to_files(df, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()

    run()
    write(spark, items, "2", [("a", 5, "x", "9"), ("c", 6, "x", "9")], ITEMS)
    run()
    assert sorted(r.link for r in spark.read.parquet(str(tmp_path / "o")).collect()) == ["a", "b", "c"]


def test_first_over_batches(spark, items, tmp_path):
    def run():
        return flows.first_stream(
            stream(spark, items), str(tmp_path / "t"), ["link"], ["o"], str(tmp_path / "c")
        ).awaitTermination()

    run()
    write(spark, items, "2", [("a", 0, "late", "9"), ("c", 6, "z", "9"), ("c", 5, "y", "9")], ITEMS)
    run()
    got = flows.read_first(spark, str(tmp_path / "t"), ["link"], ["o"])
    assert {(r.link, r.title) for r in got.collect()} == {("a", "x"), ("b", "y"), ("c", "y")}


def test_dedup_with_bounded_state(spark, tmp_path):
    schema = "k string, ts timestamp"
    import datetime as dt

    at = dt.datetime(2024, 1, 1)
    write(spark, tmp_path / "in", "1", [("a", at), ("a", at), ("b", at)], schema)
    df = flows.dedup_stream(stream(spark, tmp_path / "in", schema), ["k"], event_time="ts", delay="1 hour").select("k")
    flows.to_files(df, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "o")).collect()) == ["a", "b"]


def test_accumulate_over_batches(spark, tmp_path):
    schema = "k string, page int, o int"
    target, checkpoint, folder = str(tmp_path / "t"), str(tmp_path / "c"), tmp_path / "in"
    batches = [[("m", 1, i) for i in range(7)], [("m", 2, i) for i in range(7)], [("m", 3, i) for i in range(7)], [("m", 4, 0)]]
    for n, rows in enumerate(batches):
        write(spark, folder, str(n), rows, schema)
        flows.accumulate_stream(stream(spark, folder, schema), target, ["k"], "page", ["o"], checkpoint).awaitTermination()
    got = flows.read_accumulated(spark, target, ["k"], "page", ["o"])
    assert sorted((r.page, r.o) for r in got.collect()) == sorted([(1, i) for i in range(7)] + [(2, i) for i in range(7)] + [(3, 0)])


def test_validation_keeps_every_row(spark, items, tmp_path):
    write(spark, items, "2", [("d", 1, None, "x")], ITEMS)
    df = flows.validate_stream(stream(spark, items), ["title"], "rating")
    flows.to_files(df, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    got = {(r.link, r.o): r.flags for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    assert len(got) == 4 and got[("d", 1)] == ["missing:title", "format:rating"]
