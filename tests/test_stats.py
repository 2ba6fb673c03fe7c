import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.operators import clean, stats, validate
from reviewlens.operators.compare import run_comparison
from reviewlens.schemas import RUNS


@pytest.fixture
def ratings(spark):
    values = [8.7, 9.7, 9.6, 9.6, 9.4, 9.0, 8.8, 8.8, 9.1, 8.3]
    return spark.createDataFrame([(float(v), i * 100 + int(v * 10)) for i, v in enumerate(values)], "x double, y int"), values


def test_histogram_is_numpys(ratings):
    df, values = ratings
    got = stats.histogram(df, "x", 20).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=20)
    assert [r.n for r in got] == counts.tolist()
    assert np.allclose([r.low for r in got] + [got[-1].high], edges)


def test_histogram_of_one_value(spark):
    got = stats.histogram(spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double"), "x", 20).collect()
    counts, _ = np.histogram([5.0, 5.0], bins=20)
    assert [r.n for r in sorted(got, key=lambda r: r.bin)] == counts.tolist()


def test_kde_against_formula(ratings):
    df, values = ratings
    got = stats.kde(df, "x", 200, 20).orderBy("i").collect()
    v = np.array(values)
    width = v.std(ddof=1) * len(v) ** -0.2
    grid = np.linspace(v.min(), v.max(), 200)
    density = np.exp(-0.5 * ((grid[:, None] - v) / width) ** 2).sum(axis=1) / (len(v) * width * math.sqrt(2 * math.pi))
    assert np.allclose([r.x for r in got], grid)
    assert np.allclose([r.y for r in got], density * len(v) * (v.max() - v.min()) / 20)


def test_binned_kde_stays_close_to_the_direct_sum(spark):
    df = spark.range(20_000).select((F.randn(7) * 3 + F.when(F.col("id") % 3 == 0, 10).otherwise(0)).alias("x")).unionByName(
        spark.createDataFrame([(None,), (25.5,)], "x double")
    )
    df = spark.createDataFrame(df.toPandas(), "x double").where("x = x")
    direct = {r.i: r.y for r in stats.kde(df, "x").collect()}
    binned = {r.i: r.y for r in stats.kde_binned(df, "x").collect()}
    top = max(direct.values())
    assert len(binned) == 200 and max(abs(binned[i] - direct[i]) for i in direct) < 1e-5 * top
    assert all(r.y is None for r in stats.kde_binned(spark.createDataFrame([(5.0,), (5.0,)], "x double"), "x", 10).collect())


def test_kde_without_spread_is_null(spark):
    got = stats.kde(spark.createDataFrame([(5.0,), (5.0,)], "x double"), "x", 10).collect()
    assert len(got) == 10 and all(r.y is None for r in got)


def test_correlation_and_trend(ratings, spark):
    df, values = ratings
    ys = [i * 100 + int(v * 10) for i, v in enumerate(values)]
    assert math.isclose(stats.correlation(df, "x", "y").first().correlation, np.corrcoef(values, ys)[0, 1])
    line = stats.trend(df, "x", "y").first()
    assert np.allclose([line.slope, line.intercept], np.polyfit(values, ys, 1))
    flat = spark.createDataFrame([(1.0, 2), (1.0, 3), (None, 9)], "x double, y int")
    assert stats.correlation(flat, "x", "y").first().correlation is None


def test_bootstrap_band(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(0, 10, 3000)
    y = 2 * x + 1 + rng.normal(0, 3, 3000)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "i long, x double, y double")
    unit = F.col("i").cast("string")
    band = stats.trend_bootstrap(df, "x", "y", unit, reps=300, blocks=512).orderBy("i").toPandas()
    slope, intercept = np.polyfit(x, y, 1)
    assert np.allclose(band.y, intercept + slope * band.x)
    assert (band.low < band.y).all() and (band.y < band.high).all()
    # Width of the band against the usual formula for the fitted line.
    residual = np.std(y - intercept - slope * x, ddof=2)
    error = residual * np.sqrt(1 / len(x) + (band.x - x.mean()) ** 2 / ((x - x.mean()) ** 2).sum())
    assert np.allclose((band.high - band.low) / (2 * 1.96 * error), 1, atol=0.25)
    again = stats.trend_bootstrap(df.repartition(3), "x", "y", unit, reps=300, blocks=512).orderBy("i").toPandas()
    assert np.allclose(band.low, again.low)


def test_poisson_weights(spark):
    us = spark.range(20000).select(stats.hash_uniform(F.col("id").cast("string")).alias("u"))
    got = us.select(stats.poisson_weight(F.col("u")).alias("w")).agg(F.avg("w"), F.var_samp("w")).first()
    assert np.allclose(list(got), [1, 1], atol=0.05)


def test_sentinels_in_counts(spark):
    rows = [("未知导演", "未知类型", "未知年份"), ("甲", "犯罪 剧情", "1994"), ("甲", "剧情", "1899"), ("乙", "", "1991")]
    df = spark.createDataFrame(rows, "director string, genre string, year string")
    assert {r.director: r.n for r in stats.value_counts(df, "director", 15).collect()} == {"甲": 2, "乙": 1, "未知导演": 1}
    genres = stats.explode_counts(df, "genre", " ", exclude=["未知类型"])
    assert {r.value: r.n for r in genres.collect()} == {"剧情": 2, "犯罪": 1}
    whole = stats.shares(df, "genre", "|", 10).collect()
    assert "犯罪 剧情" in {r.value for r in whole} and math.isclose(sum(r.share for r in whole), 100)
    assert [(r.year, r.n) for r in stats.year_counts(df, "year", exclude=["未知年份"]).collect()] == [
        ("1899", 1), ("1991", 1), ("1994", 1)
    ]
    assert [(r.decade, r.n) for r in stats.decade_counts(df, F.col("year")).collect()] == [(1990, 2)]


def test_shares_cover_the_shown_rows_only(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [("c",)], "g string")
    got = {r.value: r.share for r in stats.shares(df, "g", "|", 2).collect()}
    assert np.allclose([got["a"], got["b"]], [200 / 3, 100 / 3])


def test_ties_in_top_k(spark):
    df = spark.createDataFrame([(3, 9.0), (1, 9.0), (2, 9.5), (4, None)], "id int, r double")
    assert [(x.rank, x.id) for x in stats.top_k(df, "r", 3, ["id", "r"], ["id"]).collect()] == [(1, 2), (2, 1), (3, 3)]


def test_gate_and_flags(spark):
    df = spark.createDataFrame(
        [("1", "a", "9.7", "u"), ("2", None, "x", "u"), ("3", "c", "11", ""), ("4", "d", "nan", "u"), ("5", "e", None, "u")],
        "rank string, title_cn string, rating string, detail_link string",
    )
    got = validate.validate(df, ["rank", "title_cn", "rating", "detail_link"], "rating")
    assert {r.rank: r.flags for r in got.collect()} == {
        "1": [],
        "2": ["missing:title_cn", "format:rating"],
        "3": ["missing:detail_link", "range:rating"],
        "4": ["range:rating"],
        "5": ["missing:rating"],
    }
    movies = spark.createDataFrame([("a", 1, 9.0), ("", 1, 9.0), ("b", 0, 9.0), ("c", 2, 0.0), ("d", 3, None)], "title string, rank_num int, rating double")
    gated = clean.movie_gate(movies)
    assert [r.title for r in clean.accepted(gated).collect()] == ["a"]
    assert {r.title: r.reject_reason for r in clean.rejected(gated).collect()} == {"": "title", "b": "rank_num", "c": "rating", "d": "rating"}


def test_constraint_report(spark):
    df = spark.createDataFrame([("x" * 256, None), ("x" * 255, 1)], "title string, rank_num int")
    got = {(r.column_name, r.rule): r.violations for r in validate.constraint_report(df, {"title": 255}, ["rank_num"]).collect()}
    assert got == {("title", "max_length:255"): 1, ("rank_num", "not_null"): 1}


def test_blocked_split(spark):
    df = spark.createDataFrame(
        [("http://sec.h/x", "ok"), ("http://h/x", "see sec.h now"), ("http://h/y", "请验证"), ("http://h/z", None)], "url string, html string"
    )
    good, bad = validate.split_blocked(df, ["sec.h"], ["验证"])
    assert [r.url for r in good.collect()] == ["http://h/z"] and bad.count() == 3


def runs(spark, *rows):
    return spark.createDataFrame([(r[0], True, *r[1:]) for r in rows], RUNS)


@pytest.mark.parametrize("seconds, verdict", [(120.0, "similar"), (121.0, "candidate faster"), (79.0, "baseline faster"), (80.0, "similar")])
def test_run_verdicts(spark, seconds, verdict):
    df = runs(spark, ("a", seconds, 0.0, 10, 0.0, 0, 0), ("b", 100.0, 0.0, 9, 0.05, 10, 150))
    got = run_comparison(df, "a", "b", 10).first()
    assert got.time_verdict == verdict and got.memory_ratio is None and got.size_ratio is None
    assert got.memory_verdict == "unknown"
    assert (got.completeness_baseline, got.completeness_candidate) == (1.0, 0.9)
    assert math.isclose(got.times_faster, max(seconds / 100, 100 / seconds))


def test_failed_run(spark):
    df = spark.createDataFrame([("a", False, 1.0, 1.0, 0, 1.0, 0, 0), ("b", True, 1.0, 1.0, 0, 1.0, 0, 0)], RUNS)
    got = run_comparison(df, "a", "b").first()
    assert got.time_verdict == "failed" and got.success_baseline == 0
