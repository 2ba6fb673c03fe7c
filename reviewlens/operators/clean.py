"""Missing values, ranges and record gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a value in every one of ``cols``."""
    return df.dropna(subset=list(cols))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """NULLs replaced from ``defaults``; names the frame lacks are ignored, '' stays ''."""
    known = set(df.columns)
    return df.fillna({name: value for name, value in defaults.items() if name in known})


def in_range(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    """Rows with ``low <= col <= high``."""
    return df.where(F.col(col).between(low, high))


def gate(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Adds ``reject_reason``: the first rule that holds, NULL for accepted rows."""
    reason = F.coalesce(*[F.when(cond, F.lit(name)) for name, cond in rules.items()])
    return df.withColumn("reject_reason", reason)


def movie_gate(df: DataFrame) -> DataFrame:
    """Gate of parsed movies: title, rank and rating must be there."""
    return gate(
        df,
        {
            "title": F.coalesce(F.col("title"), F.lit("")) == "",
            "rank_num": F.coalesce(F.col("rank_num"), F.lit(0)) == 0,
            "rating": F.coalesce(F.col("rating"), F.lit(0.0)) == 0.0,
        },
    )


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col("reject_reason").isNotNull())
