"""Distributions, correlation and trend."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import decade, parse_double


def row_count() -> Column:
    return F.count(F.lit(1)).alias("n")


def ranked(counts: DataFrame, top: int, *value: str) -> DataFrame:
    """The ``top`` rows by n, ties by value, with their ``rank``.

    The limit comes first, so the window sees at most ``top`` rows.
    """
    order = [F.desc("n"), *[F.asc(v) for v in value]]
    return counts.orderBy(*order).limit(top).withColumn("rank", F.row_number().over(W.orderBy(*order)))


def value_counts(df: DataFrame, col: str, top: int | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """(col, n), with a rank when ``top`` is given. Values in ``exclude`` and NULLs are not counted."""
    kept = df.where(F.col(col).isNotNull())
    if exclude:
        kept = kept.where(~F.col(col).isin(*exclude))
    counts = kept.groupBy(col).agg(row_count())
    return counts if top is None else ranked(counts, top, col)


def explode_counts(df: DataFrame, col: str, sep: str, exclude: Sequence[str] = (), top: int | None = None) -> DataFrame:
    """Counts of the parts of a multi-value column; a cell that is '' or in ``exclude`` is skipped."""
    cells = df.where(~F.col(col).isin("", *exclude))
    parts = cells.select(F.explode(F.split(col, "\\Q" + sep + "\\E")).alias("value"))
    return value_counts(parts, "value", top)


def shares(df: DataFrame, col: str, sep: str = "|", top: int = 10) -> DataFrame:
    """The ``top`` parts and their percentage of the rows shown (not of all rows)."""
    parts = df.select(F.explode(F.split(col, "\\Q" + sep + "\\E")).alias("value"))
    shown = value_counts(parts, "value", top)
    return shown.withColumn("share", F.col("n") * 100.0 / F.sum("n").over(W.partitionBy()))


def year_counts(df: DataFrame, col: str, exclude: Sequence[str] = ()) -> DataFrame:
    """Counts by year, ascending."""
    return value_counts(df, col, exclude=exclude).orderBy(col)


def decade_counts(df: DataFrame, year: Column, earliest: int = 1900) -> DataFrame:
    """(decade, n) ascending, for years that are numbers and not before ``earliest``."""
    start = decade(year)
    return (
        df.where(parse_double(year) >= earliest)
        .groupBy(start.alias("decade"))
        .agg(row_count())
        .orderBy("decade")
    )


def top_k(df: DataFrame, by: str, k: int, cols: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest ``by``, ties in the order of ``tie``, with their ``rank``."""
    order = [F.desc_nulls_last(by), *[F.asc(t) for t in tie]]
    kept = df.select(*dict.fromkeys([*cols, by, *tie])).orderBy(*order).limit(k)
    return kept.withColumn("rank", F.row_number().over(W.orderBy(*order))).select("rank", *cols)


def limit_rows(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def numeric_summary(df: DataFrame, col: str) -> DataFrame:
    return df.agg(
        F.count(col).alias("n"), F.avg(col).alias("mean"), F.min(col).alias("min"), F.max(col).alias("max")
    )


def _span(df: DataFrame, col: str) -> tuple[Column, Column]:
    """Range of ``col``, widened by half a unit each way when it is a single point."""
    low, high = F.min(col), F.max(col)
    span = df.agg(
        F.struct(
            F.when(low == high, low - 0.5).otherwise(low).cast("double").alias("low"),
            F.when(low == high, high + 0.5).otherwise(high).cast("double").alias("high"),
        ).alias("span")
    ).scalar()
    return span.getField("low"), span.getField("high")


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """(bin, low, high, n): equal bins over the value range, the last one closed, empty ones kept."""
    spark = df.sparkSession
    low, high = _span(df, col)
    step = (high - low) / F.lit(float(bins))

    def edge(i: Column) -> Column:
        return F.when(i == bins, high).otherwise(low + i * step)

    value = F.col(col).cast("double")
    guess = F.least(F.floor((value - low) / (high - low) * F.lit(float(bins))), F.lit(bins - 1)).cast("int")
    # Division can land one bin off at an edge, so the edges decide.
    bin_of = (
        F.when(value < edge(guess), guess - 1)
        .when((value >= edge(guess + 1)) & (guess < bins - 1), guess + 1)
        .otherwise(guess)
    )
    counts = df.where(F.col(col).isNotNull()).groupBy(bin_of.alias("bin")).agg(row_count())
    spine = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        edge(F.col("bin")).alias("low"),
        edge(F.col("bin") + 1).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def kde(df: DataFrame, col: str, points: int = 200, bins: int = 20) -> DataFrame:
    """(x, y): Gaussian density on a grid over the value range, Scott's bandwidth, scaled to bin counts.

    Equal values are counted first. Every task then folds its values into ``points`` sums, so the
    shuffle carries ``points`` rows per task. y is NULL where all values are the same.
    """
    values = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("v")).agg(row_count())
    facts = df.agg(
        F.struct(
            F.count(col).cast("double").alias("n"),
            F.min(col).cast("double").alias("low"),
            F.max(col).cast("double").alias("high"),
            F.stddev_samp(col).alias("sd"),
        ).alias("facts")
    ).scalar()
    n, low, high = facts.getField("n"), facts.getField("low"), facts.getField("high")
    width = facts.getField("sd") * F.pow(n, F.lit(-0.2))
    grid = low + F.col("i") * (high - low) / F.lit(float(points - 1))
    u = F.try_divide(grid - F.col("v"), width)
    scale = F.try_divide((high - low) / F.lit(float(bins)), width * F.lit((2 * math.pi) ** 0.5))
    return (
        values.select("v", "n", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
        .groupBy("i")
        .agg(F.sum(F.col("n") * F.exp(u * u * F.lit(-0.5))).alias("mass"))
        .select("i", grid.alias("x"), (F.col("mass") * scale).alias("y"))
    )


def kde_binned(df: DataFrame, col: str, points: int = 200, bins: int = 20, cells: int = 4096) -> DataFrame:
    """As ``kde``, for continuous values: (i, x, y) by linear binning, whose work per task does not depend on the distinct values.

    Each value is shared out between the two of ``cells`` equally spaced places around it, in proportion to its distance from them; what the
    shuffle carries is ``cells`` sums per task. The grid is then folded with the kernel, ``cells`` times ``points`` terms whatever
    the table holds. The error against ``kde`` is of the order of the square of a cell's width over the bandwidth.
    """
    facts = df.agg(
        F.struct(
            F.count(col).cast("double").alias("n"), F.min(col).cast("double").alias("low"), F.max(col).cast("double").alias("high"),
            F.stddev_samp(col).alias("sd"),
        ).alias("facts")
    ).scalar()
    n, low, high = facts.getField("n"), facts.getField("low"), facts.getField("high")
    last = F.lit(float(cells - 1))
    place = F.coalesce(F.try_divide(F.col(col).cast("double") - low, high - low) * last, F.lit(0.0))
    left = F.least(F.floor("place").cast("int"), F.lit(cells - 2))
    shares = F.array(
        F.struct(F.col("left").alias("cell"), (1 - (F.col("place") - F.col("left"))).alias("share")),
        F.struct((F.col("left") + 1).alias("cell"), (F.col("place") - F.col("left")).alias("share")),
    )
    placed = df.where(F.col(col).isNotNull()).select(place.alias("place")).select("place", left.alias("left"))
    grid = placed.select(F.inline(shares)).groupBy("cell").agg(F.sum("share").alias("share"))
    width = facts.getField("sd") * F.pow(n, F.lit(-0.2))
    x = low + F.col("i") * (high - low) / F.lit(float(points - 1))
    u = F.try_divide(x - (low + F.col("cell") * (high - low) / last), width)
    scale = F.try_divide((high - low) / F.lit(float(bins)), width * F.lit((2 * math.pi) ** 0.5))
    return (
        grid.select("cell", "share", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
        .groupBy("i")
        .agg(F.sum(F.col("share") * F.exp(u * u * F.lit(-0.5))).alias("mass"))
        .select("i", x.alias("x"), (F.col("mass") * scale).alias("y"))
    )


def _pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()


def correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """(n, correlation) over pairs without NULL; NULL when a column does not vary."""
    spread = F.stddev_pop("x") * F.stddev_pop("y")
    return _pairs(df, x, y).agg(
        F.count(F.lit(1)).alias("n"),
        F.try_divide(F.covar_pop("x", "y"), spread).alias("correlation"),
    )


def trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """(n, slope, intercept) of the least-squares line."""
    return _pairs(df, x, y).agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
    )


# Running sums of the Poisson(1) probabilities; a uniform number below the k-th bound has weight k.
# There are as many as a double can tell from 1.
POISSON_BOUNDS = [
    bound for k in range(30) if (bound := math.exp(-1) * math.fsum(1 / math.factorial(j) for j in range(k + 1))) < 1
]


def poisson_weight(uniform: Column) -> Column:
    weight = F.lit(len(POISSON_BOUNDS))
    for k in range(len(POISSON_BOUNDS) - 1, -1, -1):
        weight = F.when(uniform < POISSON_BOUNDS[k], F.lit(k)).otherwise(weight)
    return weight


def hash_uniform(text: Column) -> Column:
    """A number in [0, 1) that depends on ``text`` only: its MD5's first 13 hex digits over 2^52, all that a double holds."""
    return F.conv(F.left(F.md5(text), F.lit(13)), 16, 10).cast("double") / F.lit(float(1 << 52))


def trend_bootstrap(
    df: DataFrame,
    x: str,
    y: str,
    unit: Column,
    reps: int = 1000,
    seed: int = 42,
    blocks: int = 4096,
    points: int = 100,
    level: float = 0.95,
) -> DataFrame:
    """(x, y, low, high): the trend line on a grid and its bootstrap band.

    ``unit`` is a text that identifies a row. Rows fold into ``blocks`` sets of moments by the hash
    of their unit, in one pass with map-side sums; replicates then draw Poisson weights for the
    blocks. The work of the replicates is ``reps * blocks`` whatever the size of ``df``, and all
    rows take part. The band is drawn around the line fitted to all rows.
    """
    spark = df.sparkSession
    block = F.floor(hash_uniform(F.concat(F.lit("block:"), unit)) * blocks).cast("int")
    pairs = df.dropna(subset=[x, y]).select(
        F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), block.alias("block")
    )
    moments = (
        pairs.groupBy("block")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("x").alias("sx"),
            F.sum("y").alias("sy"),
            F.sum(F.col("x") * F.col("x")).alias("sxx"),
            F.sum(F.col("x") * F.col("y")).alias("sxy"),
            F.min("x").alias("lo"),
            F.max("x").alias("hi"),
        )
    )
    # The sums are few but their replicates are not, so they are dealt out to all cores.
    moments = moments.repartition(spark.sparkContext.defaultParallelism)
    draw = F.concat_ws(":", F.lit(str(seed)), F.col("block").cast("string"), F.col("rep").cast("string"))
    drawn = moments.select("*", F.explode(F.sequence(F.lit(0), F.lit(reps))).alias("rep"))
    # A column of its own, as the weight looks at it many times. Replicate 0 is the line itself.
    drawn = drawn.withColumn("u", hash_uniform(draw)).withColumn(
        "w", F.when(F.col("rep") == 0, F.lit(1)).otherwise(poisson_weight(F.col("u")))
    )
    sums = drawn.groupBy("rep").agg(
        *[F.sum(F.col("w") * F.col(c)).alias(c) for c in ("n", "sx", "sy", "sxx", "sxy")],
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
    )
    slope = F.try_divide(
        F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"), F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    )
    lines = sums.select("rep", "lo", "hi", slope.alias("b"), "n", "sx", "sy").select(
        "rep", "lo", "hi", "b", F.try_divide(F.col("sy") - F.col("b") * F.col("sx"), F.col("n")).alias("a")
    )
    at = lines.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    x_at = F.col("lo") + F.col("i") * (F.col("hi") - F.col("lo")) / F.lit(float(points - 1))
    tail = (1 - level) / 2
    fitted = at.select("i", "rep", x_at.alias("x"), (F.col("a") + F.col("b") * x_at).alias("fit"))
    sample = F.when(F.col("rep") > 0, F.col("fit"))
    return fitted.groupBy("i").agg(
        F.max("x").alias("x"),
        F.max(F.when(F.col("rep") == 0, F.col("fit"))).alias("y"),
        F.percentile(sample, F.lit(tail)).alias("low"),
        F.percentile(sample, F.lit(1 - tail)).alias("high"),
    )


class StageMetrics:
    """Counts of a run's stages from the pass that makes its result: no stage is scanned for them again.

    ``watch`` marks a stage; the metrics are there once the result was written (``Observation`` waits for that).
    """

    def __init__(self) -> None:
        self.seen: dict[str, Observation] = {}
        self.columns: dict[str, list[str]] = {}

    def watch(self, df: DataFrame, stage: str, nulls_of: Sequence[str] = ()) -> DataFrame:
        """``df`` as it is; its rows, and the NULLs of the columns ``nulls_of``, are counted on the way."""
        self.seen[stage], self.columns[stage] = Observation(), list(nulls_of)
        nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(nulls_of)]
        return df.observe(self.seen[stage], F.count(F.lit(1)).alias("n"), *nulls)

    def report(self, spark: SparkSession) -> DataFrame:
        """(stage, column_name, n): rows of each stage (column_name '') and NULLs of its columns; a few numbers per stage."""
        rows = []
        for stage, seen in self.seen.items():
            found = seen.get
            rows += [(stage, "", found["n"]), *((stage, c, found[f"null_{i}"]) for i, c in enumerate(self.columns[stage]))]
        return spark.createDataFrame(rows, "stage string, column_name string, n long")


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """(stage, n), one aggregate per named frame."""
    rows = [df.agg(F.lit(name).alias("stage"), row_count()) for name, df in stages.items()]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionAll(row)
    return out
