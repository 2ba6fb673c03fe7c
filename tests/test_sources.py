import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens import schemas as S
from reviewlens.sources import files, sinks

MOVIE = {"rank_num": "1", "title": "甲", "rating": 9.7, "comment_num": "1,234", "info": "a\nb", "quote": ""}


def test_json_array(spark, tmp_path):
    path = tmp_path / "raw.json"
    path.write_text(json.dumps([MOVIE, {"rank_num": 2, "title": None}], ensure_ascii=False), encoding="utf-8")
    got = files.load_raw(spark, str(path), S.RAW_MOVIES).orderBy("rank_num").collect()
    assert (got[0].rating, got[0].quote, got[0].runtime) == ("9.7", "", None)
    assert (got[1].rank_num, got[1].title) == ("2", None)


def test_csv_with_bom(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('title,rank_num,rating,info,quote\n甲,1,9.7,"a\n""b"", c",NA\n乙,2,,x,\n', encoding="utf-8-sig")
    got = files.load_raw(spark, str(path), S.RAW_MOVIES).orderBy("rank_num").collect()
    assert (got[0].title, got[0].info, got[0].quote) == ("甲", 'a\n"b", c', None)
    assert (got[1].rating, got[1].runtime) == (None, None)


def test_other_extension(spark):
    with pytest.raises(ValueError):
        files.load_raw(spark, "raw.xlsx", S.RAW_MOVIES)


def test_round_trips(spark, tmp_path):
    rows = [(1, 'a "q", é\n好', None), (2, "", "x"), (3, None, "")]
    df = spark.createDataFrame(rows, "i int, a string, b string")
    sinks.write_json(df, str(tmp_path / "j"))
    sinks.write_csv(df, str(tmp_path / "c"))
    assert sorted(map(tuple, files.read_json(spark, str(tmp_path / "j"), df.schema).collect())) == rows
    # CSV has one spelling for NULL and ''.
    bare = [tuple(v or None for v in row) for row in rows]
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "c"), df.schema).collect())) == bare
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "j").glob("*.json"))
    assert "好" in text


def test_nested_to_csv(spark, tmp_path):
    kind = T.StructType().add("i", "integer").add("c", T.ArrayType(S.COMMENT))
    sinks.write_csv(spark.createDataFrame([(1, [("a", "5", "t", "x")])], kind), str(tmp_path / "n"))
    got = files.read_csv(spark, str(tmp_path / "n")).first()
    assert json.loads(got.c) == [{"author": "a", "score": "5", "time": "t", "content": "x"}]


def test_json_records(spark, tmp_path):
    good, bad = tmp_path / "good.json", tmp_path / "bad.json"
    good.write_text(json.dumps([MOVIE, MOVIE]), encoding="utf-8")
    bad.write_text("{not json", encoding="utf-8")
    assert files.json_records(spark, str(good), S.RAW_MOVIES) == 2
    assert files.json_records(spark, str(bad), S.RAW_MOVIES) == 0
    assert files.json_records(spark, str(tmp_path / "none.json"), S.RAW_MOVIES) == 0


@pytest.mark.parametrize("total, want", [(0, []), (1, [0]), (25, [0]), (26, [0, 25]), (1000, list(range(0, 250, 25)))])
def test_page_offsets(spark, total, want):
    totals = spark.createDataFrame([(total,)], "n int")
    got = files.page_offsets(totals, "n", "http://h?start=%d").orderBy("start").collect()
    assert [r.start for r in got] == want
    assert [r.url for r in got] == [f"http://h?start={s}" for s in want]


def test_assets(spark, tmp_path):
    for name, size in {"a.jpg": 1025, "b.jpg": 1024, "c.jpg": 10}.items():
        (tmp_path / name).write_bytes(b"x" * size)
    expected = spark.createDataFrame([(n,) for n in ("a.jpg", "b.jpg", "c.jpg", "d.jpg")], "name string")
    got = {r.name: (r.status, r.accept_new) for r in files.asset_manifest(expected, files.list_assets(spark, str(tmp_path))).collect()}
    assert got == {"a.jpg": ("valid", True), "b.jpg": ("refetch", True), "c.jpg": ("refetch", False), "d.jpg": ("missing", False)}


def test_stored_form(spark, tmp_path):
    df = spark.createDataFrame([(1, "9.5", None, "extra")], "movie_id long, content string, username string, more string")
    got = sinks.conform(df, S.COMMENTS_TABLE, S.COMMENTS_ABSENT)
    assert got.schema.simpleString() == S.COMMENTS_TABLE.simpleString()
    assert tuple(got.first()) == (1, None, "", "9.5", "")
    path = str(tmp_path / "comments")
    sinks.ensure_table(spark, path, S.COMMENTS_TABLE)
    assert spark.read.parquet(path).count() == 0
    got.write.mode("overwrite").parquet(path)
    sinks.ensure_table(spark, path, S.COMMENTS_TABLE)
    assert spark.read.parquet(path).count() == 1


def test_folder_size(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x" * 1024 * 256)
    assert files.folder_size_mb(spark, str(tmp_path)) == 0.25
    assert files.folder_size_mb(spark, str(tmp_path / "none")) == 0


def test_runs(spark, tmp_path):
    path = str(tmp_path / "runs")
    for stamp, value in (("20240101_000000", 1), ("20240102_000000", 2), ("20240102_000000", 3)):
        sinks.write_run(spark.createDataFrame([(value,)], "v int"), path, stamp)
    assert [r.v for r in sinks.read_latest_run(spark, path).collect()] == [3]
    assert sorted(r.v for r in sinks.read_runs(spark, path).collect()) == [1, 3]


def test_fan_out_computes_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            calls.add(len(b))
            yield b

    seen = []
    df = spark.range(100).mapInPandas(count, "id long")
    sinks.fan_out(df, [lambda d: seen.append(("a", d.count())), lambda d: seen.append(("b", d.agg(F.sum("id")).first()[0]))])
    assert seen == [("a", 100), ("b", 4950)] and calls.value == 100


def test_load_times(spark):
    row = sinks.with_load_time(spark.range(1)).select("created_at", sinks.iso_now().alias("iso")).first()
    assert row.created_at is not None and len(row.iso) == 26 and row.iso[10] == "T"


class FakeWriter:
    """Stands where a database would be: none may be started here."""

    def __init__(self):
        self.options, self.target = {}, None

    def mode(self, m):
        self.options["mode"] = m
        return self

    def option(self, k, v):
        self.options[k] = v
        return self

    def jdbc(self, url, table, properties):
        self.target = (url, table)


def test_jdbc_replace_checks_first(spark, monkeypatch):
    made = []
    kind = type(spark.range(1))
    monkeypatch.setattr(kind, "write", property(lambda self: made.append(FakeWriter()) or made[-1]))
    sinks.jdbc_replace(spark.range(3), "jdbc:x", "movies", ["id"])
    assert made[0].target == ("jdbc:x", "movies")
    assert made[0].options == {"mode": "overwrite", "truncate": True, "batchsize": 5000}
    with pytest.raises(sinks.ConstraintError):
        sinks.jdbc_replace(spark.range(3).union(spark.range(1)), "jdbc:x", "movies", ["id"])
    assert len(made) == 1


def test_csv_with_mark_and_one_record_per_line(spark, tmp_path):
    df = spark.createDataFrame([(1, "甲"), (2, "b")], "id int, t string")
    sinks.write_csv(df.coalesce(1), str(tmp_path / "m"), bom=True)
    (part,) = (tmp_path / "m").glob("part-*.csv")
    assert part.read_bytes().startswith(b"\xef\xbb\xbfid,t")
    for multi_line in (True, False):
        got = files.read_csv(spark, str(tmp_path / "m"), df.schema, multi_line)
        assert sorted(map(tuple, got.collect())) == [(1, "甲"), (2, "b")]


def test_constraints_refuse_a_load(spark, tmp_path):
    good = spark.createDataFrame([(1, "a")], "rank_num int, title string")
    sinks.replace_table(good, str(tmp_path / "t"), ["rank_num"], "1", {"title": 3}, ["title"])
    for bad in ([(1, "long"), (2, "a")], [(1, None)]):
        with pytest.raises(sinks.ConstraintError):
            sinks.replace_table(spark.createDataFrame(bad, good.schema), str(tmp_path / "t"), ["rank_num"], "2", {"title": 3}, ["title"])
    assert [tuple(r)[:2] for r in sinks.read_runs(spark, str(tmp_path / "t")).collect()] == [(1, "a")]
