"""Comparison of two runs of the same collection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ratios (baseline over candidate) beyond which one run is called better.
TIME_BOUNDS = (0.8, 1.2)
MEMORY_BOUNDS = (0.7, 1.5)


def _ratio(a: Column, b: Column) -> Column:
    return F.when((a > 0) & (b > 0), a / b)


def _times(ratio: Column) -> Column:
    """By how much the better run wins."""
    return F.when(ratio > 1, ratio).otherwise(1 / ratio)


def run_comparison(runs: DataFrame, baseline: str, candidate: str, limit: int = 10) -> DataFrame:
    """One row: ratios (NULL unless both values are above 0), completeness, success and verdicts."""

    def value(run: str, col: str) -> Column:
        return F.max(F.when(F.col("run") == run, F.col(col)))

    names = {"baseline": baseline, "candidate": candidate}
    cols = ["success", "execution_time", "memory_used", "data_count", "db_size_mb", "movies", "comments"]
    wide = runs.where(F.col("run").isin(baseline, candidate)).agg(
        *[value(run, c).alias(f"{side}_{c}") for side, run in names.items() for c in cols]
    )

    def ratio(col: str) -> Column:
        return _ratio(F.col(f"baseline_{col}"), F.col(f"candidate_{col}"))

    both = F.coalesce(F.col("baseline_success") & F.col("candidate_success"), F.lit(False))
    time, memory = ratio("execution_time"), ratio("memory_used")
    return wide.select(
        time.alias("time_ratio"),
        memory.alias("memory_ratio"),
        ratio("db_size_mb").alias("size_ratio"),
        *[
            F.coalesce(F.col(f"{side}_success"), F.lit(False)).cast("int").alias(f"success_{side}")
            for side in names
        ],
        *[(F.col(f"{side}_data_count") / F.lit(limit)).alias(f"completeness_{side}") for side in names],
        *[F.col(f"{side}_{c}") for side in names for c in ("movies", "comments")],
        F.when(time > 1, F.lit("candidate")).when(time <= 1, F.lit("baseline")).alias("faster"),
        _times(time).alias("times_faster"),
        F.when(~both, F.lit("failed"))
        .when(time.isNull(), F.lit("unknown"))
        .when(time > TIME_BOUNDS[1], F.lit("candidate faster"))
        .when(time < TIME_BOUNDS[0], F.lit("baseline faster"))
        .otherwise(F.lit("similar"))
        .alias("time_verdict"),
        F.when(~both, F.lit("failed"))
        .when(memory.isNull(), F.lit("unknown"))
        .when(memory > MEMORY_BOUNDS[1], F.lit("candidate leaner"))
        .when(memory < MEMORY_BOUNDS[0], F.lit("baseline leaner"))
        .otherwise(F.lit("similar"))
        .alias("memory_verdict"),
    )
