"""Counts, top-k, distributions, correlation, trend, run comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stats
from ..operators.compare import run_comparison as compare_runs
from .base import query, sql_uniform, table


@query(
    """
SELECT CAST(row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS INTEGER) AS rank,
  p_partkey, p_name, p_retailprice, p_size, p_brand
FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10
"""
)
def topk_rating(spark, sf):
    cols = ["p_partkey", "p_name", "p_retailprice", "p_size", "p_brand"]
    return stats.top_k(table(spark, sf, "part"), "p_retailprice", 10, cols, ["p_partkey"])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 250")
def limit_n(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return stats.limit_rows(orders, [F.desc("o_totalprice"), "o_orderkey"], 250)


@query(
    """
SELECT p_brand, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) AS INTEGER) AS rank
FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 15
"""
)
def value_counts_top(spark, sf):
    return stats.value_counts(table(spark, sf, "part"), "p_brand", 15)


@query(
    """
SELECT value, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS value FROM part
  WHERE p_name NOT IN ('', 'red plate')) GROUP BY value
"""
)
def explode_counts(spark, sf):
    return stats.explode_counts(table(spark, sf, "part"), "p_name", " ", exclude=["red plate"])


@query(
    """
WITH c AS (SELECT p_name AS value, count(*) AS n FROM part GROUP BY p_name ORDER BY n DESC, value LIMIT 10)
SELECT value, n, CAST(row_number() OVER (ORDER BY n DESC, value) AS INTEGER) AS rank,
  round(n * 100.0::DOUBLE / sum(n) OVER (), 6) AS share FROM c
"""
)
def share_top(spark, sf):
    shown = stats.shares(table(spark, sf, "part"), "p_name", "|", 10)
    return shown.withColumn("share", F.round("share", 6))


@query("SELECT strftime(o_orderdate, '%Y') AS year, count(*) AS n FROM orders GROUP BY ALL")
def year_counts(spark, sf):
    orders = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy").alias("year"))
    return stats.year_counts(orders, "year", exclude=["未知年份"])


@query(
    """
SELECT CAST(floor(year(o_orderdate) / 10) * 10 AS INTEGER) AS decade, count(*) AS n FROM orders
WHERE year(o_orderdate) >= 1900 GROUP BY ALL
"""
)
def decade_counts(spark, sf):
    return stats.decade_counts(table(spark, sf, "orders"), F.year("o_orderdate").cast("string"))


@query(
    """
SELECT count(p_retailprice) AS n, round(avg(p_retailprice), 6) AS mean, min(p_retailprice) AS min,
  max(p_retailprice) AS max FROM part
"""
)
def numeric_summary(spark, sf):
    return stats.numeric_summary(table(spark, sf, "part"), "p_retailprice").withColumn("mean", F.round("mean", 6))


@query(
    """
WITH r AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
e AS (SELECT CAST(i AS INTEGER) AS bin, lo + i * ((hi - lo) / 20.0::DOUBLE) AS low,
        CASE WHEN i = 19 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 20.0::DOUBLE) END AS high
      FROM r, (SELECT unnest(generate_series(0, 19)) AS i)),
c AS (SELECT e.bin, count(*) AS n FROM lineitem l JOIN e
      ON l.l_extendedprice >= e.low AND (l.l_extendedprice < e.high OR (e.bin = 19 AND l.l_extendedprice <= e.high))
      GROUP BY e.bin)
SELECT bin, round(low, 6) AS low, round(high, 6) AS high, coalesce(n, 0) AS n FROM e LEFT JOIN c USING (bin)
"""
)
def histogram20(spark, sf):
    bins = stats.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 20)
    return bins.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


@query(
    """
WITH f AS (SELECT count(p_retailprice) AS n, min(p_retailprice) AS lo, max(p_retailprice) AS hi,
  stddev_samp(p_retailprice) * pow(count(p_retailprice), -0.2) AS w FROM part),
g AS (SELECT CAST(i AS INTEGER) AS i, lo + i * (hi - lo) / 199.0::DOUBLE AS x FROM f, (SELECT unnest(generate_series(0, 199)) AS i)),
c AS (SELECT p_retailprice AS v, count(*) AS n FROM part GROUP BY ALL)
SELECT g.i, round(any_value(g.x), 6) AS x,
  round(sum(c.n * exp(-0.5 * ((g.x - c.v) / f.w) * ((g.x - c.v) / f.w)))
    / any_value(f.w * sqrt(2 * pi())) * any_value((f.hi - f.lo) / 20), 6) AS y
FROM g, c, f GROUP BY g.i
"""
)
def kde_grid(spark, sf):
    curve = stats.kde(table(spark, sf, "part"), "p_retailprice")
    return curve.withColumns({"x": F.round("x", 6), "y": F.round("y", 6)})


@query(
    """
WITH f AS (
  SELECT count(*)::DOUBLE AS n, min(l_extendedprice) AS low, max(l_extendedprice) AS high,
    stddev_samp(l_extendedprice) * pow(count(*)::DOUBLE, -0.2) AS width FROM lineitem),
p AS (SELECT (l_extendedprice - low) / (high - low) * 4095 AS place FROM lineitem, f WHERE l_extendedprice IS NOT NULL),
s AS (SELECT place, least(floor(place), 4094) AS cell FROM p),
c AS (
  SELECT cell, sum(share) AS share FROM (
    SELECT cell, 1 - (place - cell) AS share FROM s UNION ALL SELECT cell + 1, place - cell FROM s) GROUP BY cell),
g AS (SELECT i, low + i * (high - low) / 199.0 AS x, low, high, width FROM f, range(200) t(i))
SELECT CAST(g.i AS INTEGER) AS i, round(any_value(g.x), 6) AS x,
  round(sum(share * exp(-0.5 * pow((g.x - (low + cell * (high - low) / 4095.0)) / width, 2)))
    * any_value((high - low) / 20.0 / (width * sqrt(2 * pi()))), 6) AS y
FROM g, c GROUP BY g.i
"""
)
def kde_continuous(spark, sf):
    curve = stats.kde_binned(table(spark, sf, "lineitem"), "l_extendedprice")
    return curve.withColumns({"x": F.round("x", 6), "y": F.round("y", 6)})


@query(
    """
SELECT count(*) AS n, round(corr(l_extendedprice, l_quantity), 6) AS correlation FROM lineitem
WHERE l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL
"""
)
def correlation(spark, sf):
    found = stats.correlation(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return found.withColumn("correlation", F.round("correlation", 6))


@query(
    """
SELECT count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
  round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept FROM lineitem
"""
)
def linear_trend(spark, sf):
    line = stats.trend(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return line.withColumns({"slope": F.round("slope", 6), "intercept": F.round("intercept", 6)})


REPS, BLOCKS, POINTS = 1000, 4096, 100
_WEIGHT = (
    "CASE "
    + " ".join(f"WHEN u < {bound!r}::DOUBLE THEN {k}" for k, bound in enumerate(stats.POISSON_BOUNDS))
    + f" ELSE {len(stats.POISSON_BOUNDS)} END"
)


@query(
    f"""
WITH m AS (
  SELECT CAST(floor({sql_uniform("concat('block:', l_orderkey, '|', l_linenumber, '|', l_partkey)")} * {BLOCKS}) AS INTEGER)
      AS block, count(*) AS n, sum(l_quantity) AS sx, sum(l_extendedprice) AS sy, sum(l_quantity * l_quantity) AS sxx,
    sum(l_quantity * l_extendedprice) AS sxy, min(l_quantity) AS lo, max(l_quantity) AS hi
  FROM lineitem GROUP BY ALL),
d AS (SELECT *, {sql_uniform("concat('42:', block, ':', rep)")} AS u
  FROM m, (SELECT unnest(generate_series(0, {REPS})) AS rep)),
w AS (SELECT *, CASE WHEN rep = 0 THEN 1 ELSE {_WEIGHT} END AS k FROM d),
s AS (SELECT rep, sum(k * n) AS n, sum(k * sx) AS sx, sum(k * sy) AS sy, sum(k * sxx) AS sxx, sum(k * sxy) AS sxy,
  min(lo) AS lo, max(hi) AS hi FROM w GROUP BY rep),
b AS (SELECT *, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS b FROM s),
f AS (SELECT CAST(i AS INTEGER) AS i, rep, lo + i * (hi - lo) / {POINTS - 1}.0::DOUBLE AS x,
    (sy - b * sx) / n + b * (lo + i * (hi - lo) / {POINTS - 1}.0::DOUBLE) AS fit
  FROM b, (SELECT unnest(generate_series(0, {POINTS - 1})) AS i))
SELECT i, round(max(x), 4) AS x, round(max(fit) FILTER (rep = 0), 4) AS y,
  round(quantile_cont(fit, 0.025) FILTER (rep > 0), 4) AS low,
  round(quantile_cont(fit, 0.975) FILTER (rep > 0), 4) AS high
FROM f GROUP BY i
"""
)
def trend_bootstrap(spark, sf):
    unit = F.concat_ws("|", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey")])
    band = stats.trend_bootstrap(
        table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", unit, REPS, 42, BLOCKS, POINTS
    )
    return band.withColumns({c: F.round(c, 4) for c in ("x", "y", "low", "high")})


@query(
    """
WITH r AS (SELECT l_returnflag AS run, true AS success, sum(l_quantity) AS t, sum(l_tax) AS m, count(*) AS n,
  sum(l_extendedprice) AS s, count(DISTINCT l_partkey) AS movies, count(DISTINCT l_orderkey) AS comments
  FROM lineitem GROUP BY ALL),
p AS (SELECT a.t / b.t AS tr, a.m / b.m AS mr, a.s / b.s AS sr, a.n AS an, b.n AS bn, a.movies AS am, b.movies AS bm,
  a.comments AS ac, b.comments AS bc FROM r a, r b WHERE a.run = 'A' AND b.run = 'R')
SELECT round(tr, 6) AS time_ratio, round(mr, 6) AS memory_ratio, round(sr, 6) AS size_ratio,
  1 AS success_baseline, 1 AS success_candidate,
  an / 1000.0::DOUBLE AS completeness_baseline, bn / 1000.0::DOUBLE AS completeness_candidate,
  am AS baseline_movies, ac AS baseline_comments, bm AS candidate_movies, bc AS candidate_comments,
  CASE WHEN tr > 1 THEN 'candidate' ELSE 'baseline' END AS faster,
  round(CASE WHEN tr > 1 THEN tr ELSE 1 / tr END, 6) AS times_faster,
  CASE WHEN tr > 1.2 THEN 'candidate faster' WHEN tr < 0.8 THEN 'baseline faster' ELSE 'similar' END AS time_verdict,
  CASE WHEN mr > 1.5 THEN 'candidate leaner' WHEN mr < 0.7 THEN 'baseline leaner' ELSE 'similar' END AS memory_verdict
FROM p
"""
)
def run_comparison(spark, sf):
    runs = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_returnflag").alias("run"))
        .agg(
            F.lit(True).alias("success"),
            F.sum("l_quantity").alias("execution_time"),
            F.sum("l_tax").alias("memory_used"),
            F.count(F.lit(1)).alias("data_count"),
            F.sum("l_extendedprice").alias("db_size_mb"),
            F.countDistinct("l_partkey").alias("movies"),
            F.countDistinct("l_orderkey").alias("comments"),
        )
    )
    report = compare_runs(runs, "A", "R", 1000)
    return report.withColumns(
        {c: F.round(c, 6) for c in ("time_ratio", "memory_ratio", "size_ratio", "times_faster")}
    )
