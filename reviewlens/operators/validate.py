"""Checks that report and never drop."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import parse_double
from ..functions.texts import strip


def flags(required: Sequence[str], number: str, low: float = 0, high: float = 10) -> Column:
    """Names of the rules a row breaks: ``missing:<col>``, ``format:<col>``, ``range:<col>``."""
    missing = [
        F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", F.lit(f"missing:{c}")) for c in required
    ]
    text = F.col(number).cast("string")
    value = parse_double(text)
    # Text Python reads as a float although it is no finite number.
    special = F.lower(strip(text)).rlike("^[+-]?(nan|inf|infinity)$")
    present = F.coalesce(text, F.lit("")) != ""
    number_rule = F.when(
        present,
        F.when(special | (value < low) | (value > high), F.lit(f"range:{number}")).when(
            value.isNull(), F.lit(f"format:{number}")
        ),
    )
    return F.array_compact(F.array(*missing, number_rule))


def validate(df: DataFrame, required: Sequence[str], number: str, low: float = 0, high: float = 10) -> DataFrame:
    """Adds ``flags``; every row passes. Works on a stream as well."""
    return df.withColumn("flags", flags(required, number, low, high))


def null_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, nulls, total_rows), all columns counted in one pass."""
    cols = list(cols or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in cols],
    )
    return counted.unpivot(["total_rows"], cols, "column_name", "nulls").select(
        "column_name", "nulls", "total_rows"
    )


def constraint_report(df: DataFrame, limits: Mapping[str, int], not_null: Sequence[str] = ()) -> DataFrame:
    """(column_name, rule, violations): texts over their limit, NULLs where none may be."""
    checks = [(c, f"max_length:{n}", F.length(F.col(c)) > n) for c, n in limits.items()]
    checks += [(c, "not_null", F.col(c).isNull()) for c in not_null]
    counted = df.agg(*[F.count_if(cond).alias(f"v{i}") for i, (_, _, cond) in enumerate(checks)])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.lit(rule).alias("rule"), F.col(f"v{i}").alias("violations"))
        for i, (c, rule, _) in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


def blocked(url: Column, html: Column, hosts: Sequence[str] = (), phrases: Sequence[str] = ()) -> Column:
    """True for a page whose address or body names a marker host, or whose body holds a phrase."""
    hit = F.lit(False)
    for host in hosts:
        hit = hit | F.contains(url, F.lit(host)) | F.contains(html, F.lit(host))
    for phrase in phrases:
        hit = hit | F.contains(html, F.lit(phrase))
    return F.coalesce(hit, F.lit(False))


def split_blocked(
    pages: DataFrame, hosts: Sequence[str] = (), phrases: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(good pages, pages to fetch again)."""
    marked = blocked(F.col("url"), F.col("html"), hosts, phrases)
    return pages.where(~marked), pages.where(marked)
