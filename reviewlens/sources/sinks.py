"""Sinks. Files are written by all tasks at once; every function returns nothing but ``upsert``."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.relate import fk_valid, has_null, keep_last_named, unique_violations
from ..operators.validate import constraint_report
from .files import open_parquet

Writer = Callable[[DataFrame], None]


class ConstraintError(ValueError):
    """A load was refused; the table it was meant for is as before."""


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", bom: bool = False) -> None:
    """CSV with a header. Nested columns are written as JSON text.

    With ``bom`` every part file begins with a byte-order mark, which stands before its header.
    """
    nested = ("array", "struct", "map")
    flat = [
        F.to_json(name).alias(name) if kind.startswith(nested) else F.col(name) for name, kind in df.dtypes
    ]
    out = df.select(*flat)
    if bom:
        out = out.withColumnRenamed(out.columns[0], "\ufeff" + out.columns[0])
    out.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON Lines in UTF-8, characters as they are, NULL fields kept."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def with_load_time(df: DataFrame, col: str = "created_at") -> DataFrame:
    return df.withColumn(col, F.current_timestamp())


def iso_now():
    """Processing time as an ISO text."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def conform(df: DataFrame, schema: T.StructType, absent: Mapping[str, object]) -> DataFrame:
    """The columns of ``schema`` in its types; one that ``df`` lacks gets its default or NULL.

    A NULL that ``df`` brings stays NULL: defaults stand for columns, not for values.
    """
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(absent.get(f.name))).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty table at ``path`` unless there is a table already."""
    if open_parquet(spark, path) is None:
        spark.createDataFrame([], schema).write.parquet(path)


def check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Refuse a load in which a key repeats."""
    bad = unique_violations(df, keys).limit(5).collect()
    if bad:
        raise ConstraintError(f"duplicate {'/'.join(keys)}: {[tuple(r)[:-1] for r in bad]}")


def check_constraints(df: DataFrame, limits: Mapping[str, int], not_null: Sequence[str] = ()) -> None:
    """Refuse a load with texts over their limit or NULLs where none may be."""
    bad = constraint_report(df, limits, not_null).where("violations > 0").collect()
    if bad:
        raise ConstraintError(", ".join(f"{r.column_name} {r.rule}: {r.violations}" for r in bad))


def write_run(df: DataFrame, path: str, run_ts: str) -> None:
    """Keep earlier results: each run has a folder of its own, which a repeated run replaces."""
    df.write.mode("overwrite").parquet(f"{path}/run_ts={run_ts}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_latest_run(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the latest run. The run is found first, so only its folder is scanned."""
    runs = read_runs(spark, path)
    latest = runs.agg(F.max("run_ts")).scalar()
    return runs.where(F.col("run_ts") == latest)


def replace_table(df: DataFrame, path: str, keys: Sequence[str], run_ts: str,
                  limits: Mapping[str, int] | None = None, not_null: Sequence[str] = ()) -> None:
    """New content for a table: checked first, then written beside the old and read instead of it."""
    check_unique(df, keys)
    if limits or not_null:
        check_constraints(df, limits or {}, not_null)
    write_run(df, path, run_ts)


def jdbc_replace(
    df: DataFrame,
    url: str,
    table: str,
    keys: Sequence[str] = (),
    connections: int = 8,
    batch: int = 5000,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Truncate a database table and fill it. Keys are checked before anything is changed.

    Each connection commits its own part; a load that must appear at once goes to a staging table first.
    """
    if keys:
        check_unique(df, keys)
    writer = df.repartition(connections).write.mode("overwrite").option("truncate", True).option("batchsize", batch)
    writer.jdbc(url, table, properties=dict(properties or {}))


def comments_for_load(reviews: DataFrame, movies: DataFrame, rank: str = "rank_num") -> DataFrame:
    """Reviews under the names of the stored table; those of unknown movies are left out."""
    renamed = reviews.withColumnsRenamed({"movie_rank": "movie_id", "comment_time": "time"})
    return fk_valid(renamed, movies.select(F.col(rank).alias("movie_id")), ["movie_id"])


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence) -> DataFrame:
    """``target`` with the last row per key of ``batch`` in place of its own; all columns are replaced.

    Rows with a NULL in their key replace nothing and are replaced by nothing.
    """
    return _replaced(target, keep_last_named(batch, keys, order_by), keys)


def _replaced(target: DataFrame, newest: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(newest.select(*keys), list(keys), "left_anti").unionByName(newest)


PART = "key_part"


def upsert_table(batch: DataFrame, path: str, keys: Sequence[str], order_by: Sequence, parts: int = 64) -> None:
    """As ``upsert``, into the table at ``path``, of which only the parts that hold keys of the batch are read and replaced.

    The table has one folder per part of the keys' hashes; rows with a NULL in their key are dealt out by all of their columns.
    The new files of a part take the place of its old ones when all are written. ``parts`` is fixed when the table is made.
    """
    spark = batch.sparkSession
    columns = sorted(batch.columns)
    by = F.when(has_null(keys), F.xxhash64(*columns)).otherwise(F.xxhash64(*keys))
    newest = keep_last_named(batch, keys, order_by).withColumn(PART, F.pmod(by, F.lit(parts)).cast("int"))
    held = open_parquet(spark, path)
    if held is not None:
        touched = [r[0] for r in newest.select(PART).distinct().collect()]  # at most ``parts`` numbers
        if not touched:
            return
        newest = _replaced(held.where(F.col(PART).isin(touched)), newest, keys)
    writer = newest.repartition(parts, PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(PART).parquet(path)


def read_upserted_table(spark: SparkSession, path: str) -> DataFrame:
    """The table behind ``upsert_table``."""
    return spark.read.parquet(path).drop(PART)


def fan_out(df: DataFrame, writers: Sequence[Writer]) -> None:
    """Hand the same rows to each writer in turn. They are computed once and spill to disk."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for writer in writers:
            writer(held)
    finally:
        held.unpersist()
