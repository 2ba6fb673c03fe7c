import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.operators import relate
from reviewlens.sources import sinks


def values(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.fixture
def reviews(spark):
    tail = "x" * 100
    rows = [
        (1, 1, "ann", tail + "a"),
        (2, 1, "ann", tail + "b"),
        (3, 1, "bob", tail + "a"),
        (4, 1, "cat", ""),
        (5, 0, "dan", "orphan"),
        (6, 9, "eve", "orphan"),
        (7, None, "fay", "no movie"),
    ]
    return spark.createDataFrame(rows, "ordinal long, movie_rank int, username string, content string")


def test_dedup_reviews_keeps_first_and_drops_empty(reviews):
    kept = relate.dedup_reviews(reviews.repartition(5), "movie_rank", "username", "content", ["ordinal"])
    assert values(kept, "ordinal") == [(1,), (3,), (5,), (6,), (7,)]


def test_semi_and_anti_are_all(spark, reviews):
    movies = spark.createDataFrame([(1,), (2,)], "movie_rank int")
    valid = relate.fk_valid(reviews, movies, ["movie_rank"])
    orphans = relate.fk_rejects(reviews, movies, ["movie_rank"])
    assert values(valid, "ordinal") == [(1,), (2,), (3,), (4,)]
    assert values(orphans, "ordinal") == [(5,), (6,), (7,)]
    left = relate.cascade_delete(reviews, movies.where("movie_rank = 1"), ["movie_rank"])
    assert values(left, "ordinal") == [(5,), (6,), (7,)]


def test_comments_for_load_renames(spark, reviews):
    movies = spark.createDataFrame([(1,)], "rank_num int")
    stored = sinks.comments_for_load(reviews.withColumn("comment_time", F.lit("t")), movies)
    assert set(stored.columns) == {"ordinal", "movie_id", "username", "content", "time"}
    assert stored.count() == 4


def test_first_k_with_a_hot_key(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("o")
    )
    kept = relate.first_k(rows.repartition(16), ["k"], ["o"], 15)
    assert values(kept.where("k = -1"), "o") == [(3 * i,) for i in range(15)]
    assert kept.count() == 20000 + 15
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one before the shuffle, one after


def test_keep_last_takes_nulls_too(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "y")], "k string, o int, v string")
    assert values(relate.keep_last(rows, ["k"], ["o"]).na.fill("null"), "k", "v") == [("a", "null"), ("b", "y")]


@pytest.mark.parametrize(
    "sizes, kept, read, seen",
    [([7, 7, 7, 7], 15, 3, 21), ([20, 5], 15, 1, 20), ([3, 3, 3, 3], 9, 3, 9), ([16], 15, 3, 16), ([15, 1], 15, 1, 15)],
)
def test_page_accumulation(spark, sizes, kept, read, seen):
    rows = [("m", p, i) for p, n in enumerate(sizes, start=1) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, page int, o int")
    assert relate.accumulate_pages(df, ["k"], "page", ["o"]).count() == kept
    report = relate.pages_read(df, ["k"], "page").first()
    # A single page of 16 is read alone.
    assert (report.pages_read, report.rows_seen) == (1 if sizes == [16] else read, seen)


def test_row_ids_are_gap_free_and_in_order(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("o"), F.col("id").alias("v"))
    ids = relate.with_row_id(rows.repartition(11), ["o"]).orderBy("o").collect()
    assert [r.id for r in ids] == list(range(1, 5001))


def test_surrogate_mismatch(spark):
    movies = spark.createDataFrame([(1, "a"), (3, "b")], "rank_num int, title string")
    report = relate.surrogate_mismatch(relate.with_row_id(movies, ["rank_num"]), "rank_num")
    assert values(report, "rank_num", "id") == [(3, 2)]


def test_override(spark):
    base = spark.createDataFrame([("u", "t", "old"), ("v", "s", "old"), ("w", "r", "old")], "url string, title string, year string")
    detail = spark.createDataFrame([("u", "1994", "9"), ("v", None, "8")], "url string, year string, imdb string")
    got = relate.override(base, detail, "url", ["year", "imdb"])
    assert values(got, "url", "title", "year", "imdb") == [("u", "t", "1994", "9"), ("v", "s", "", "8"), ("w", "r", "", "")]
    kept = relate.override(base, detail, "url", ["year"], missing=None)
    assert values(kept, "url", "year") == [("u", "1994"), ("v", "old"), ("w", "old")]


def test_unique_check_refuses(spark, tmp_path):
    path = str(tmp_path / "movies")
    good = spark.createDataFrame([(1, "a"), (2, "b")], "rank_num int, title string")
    sinks.replace_table(good, path, ["rank_num"], "20240101_000000")
    bad = spark.createDataFrame([(1, "a"), (1, "c")], "rank_num int, title string")
    with pytest.raises(sinks.ConstraintError):
        sinks.replace_table(bad, path, ["rank_num"], "20240102_000000")
    assert values(sinks.read_latest_run(spark, path), "title") == [("a",), ("b",)]


def test_upsert_replaces_whole_rows(spark):
    target = spark.createDataFrame([("a", "1", "x"), ("b", "1", "y")], "k string, v string, w string")
    batch = spark.createDataFrame([("a", "2", "p"), ("a", "3", None), ("c", "1", "z")], "k string, v string, w string")
    got = sinks.upsert(target, batch, ["k"], ["v"]).na.fill("null")
    assert values(got, "k", "v", "w") == [("a", "3", "null"), ("b", "1", "y"), ("c", "1", "z")]


def test_union_sorted(spark):
    a = spark.createDataFrame([(1, "x")], "b int, a string")
    b = spark.createDataFrame([(2, "y")], "b int, c string")
    got = relate.union_sorted(a, b)
    assert got.columns == ["a", "b", "c"]
    assert {tuple(r) for r in got.collect()} == {("x", 1, None), (None, 2, "y")}


def test_nested_split(spark):
    kind = T.ArrayType(T.StructType().add("author", "string").add("content", "string"))
    schema = T.StructType().add("id", "long").add("title", "string").add("hot_comments", kind)
    items = spark.createDataFrame([(1, "a", [("p", "x"), ("q", "y")]), (2, "b", []), (3, "c", None)], schema)
    parents, children = relate.split_nested(items, "hot_comments", "id")
    assert parents.columns == ["id", "title"] and parents.count() == 3
    assert values(children, "id", "position", "author") == [(1, 1, "p"), (1, 2, "q")]


def test_text_fallback(spark):
    kind = T.ArrayType(T.StructType().add("content", "string"))
    items = spark.createDataFrame([([("n1",), ("",)],), (None,)], T.StructType().add("c", kind))
    own = spark.createDataFrame([("o1",), ("",)], "t string")
    assert values(relate.texts_or_nested(own, "t", items, "c", "content"), "content") == [("o1",)]
    assert values(relate.texts_or_nested(own.where("t = ''"), "t", items, "c", "content"), "content") == [("n1",)]


def test_columns_from_the_keys_of_the_data(spark):
    rows = [(1, '{"b": 1, "a": "x"}'), (2, '{"c d": null, "a": [1, 2]}'), (3, None), (4, "no json"), (5, "{}"), (6, '{"id": 9, "q\'s": true}')]
    got = relate.open_columns(spark.createDataFrame(rows, "id int, props string"), "props")
    assert got.columns == ["id", "a", "b", "c d", "q's"]
    by = {r.id: tuple(r)[1:] for r in got.collect()}
    assert by == {
        1: ("x", "1", None, None), 2: ("[1,2]", None, None, None), 3: (None,) * 4, 4: (None,) * 4, 5: (None,) * 4, 6: (None, None, None, "true")
    }
