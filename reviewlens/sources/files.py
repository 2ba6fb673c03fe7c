"""Scans: raw movie files, tables, page offsets, assets, counts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LIST_CAP, LIST_STEP

# Cell texts of a CSV file that mean "no value".
CSV_MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True) -> DataFrame:
    """CSV with a header; a byte-order mark is understood, and with ``multi_line`` line breaks inside quotes.

    A file with line breaks inside quotes is read by one task. Without ``multi_line`` each record is one line
    and large files are split. The format has one spelling for NULL and '', which is read as NULL.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    return reader.schema(schema).csv(path) if schema else reader.csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType, lines: bool = True) -> DataFrame:
    """JSON Lines, or with ``lines=False`` files that each hold one array (read by one task per file)."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def load_raw(spark: SparkSession, path: str, schema: T.StructType, lines: bool = False) -> DataFrame:
    """Raw records from ``.json`` or ``.csv``; a column the file lacks is NULL. ``lines``: one record per line."""
    if path.endswith(".json"):
        return read_json(spark, path, schema, lines)
    if path.endswith(".csv"):
        cells = read_csv(spark, path, multi_line=not lines)
        cols = []
        for f in schema.fields:
            cell = F.col(f"`{f.name}`") if f.name in cells.columns else F.lit(None).cast("string")
            cols.append(F.when(~cell.isin(*CSV_MISSING), cell).try_cast(f.dataType).alias(f.name))
        return cells.select(*cols)
    raise ValueError(f"only .json and .csv can be loaded, not {path}")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_col: str | None = None,
    low: int = 0,
    high: int = 0,
    partitions: int = 1,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table; with ``partition_col`` it is read over several connections at once."""
    props = dict(properties or {})
    if partition_col is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(
        url, table, column=partition_col, lowerBound=low, upperBound=high, numPartitions=partitions, properties=props
    )


def page_offsets(totals: DataFrame, total: str, template: str, cap: int = LIST_CAP, step: int = LIST_STEP) -> DataFrame:
    """One row per list page to fetch: the columns of ``totals``, ``start`` and ``url``.

    ``template`` holds ``%d`` for the offset. Offsets run from 0 below ``least(cap, total)``.
    """
    end = F.least(F.lit(cap), F.col(total)).cast("int") - 1
    starts = totals.where(F.col(total) > 0).select("*", F.explode(F.sequence(F.lit(0), end, F.lit(step))).alias("start"))
    return starts.withColumn("url", F.format_string(template, F.col("start")))


def table_counts(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """(table_name, n) for the named tables, one at least; a table that could not be opened (None) counts 0."""
    out = None
    for name, df in tables.items():
        if df is None:
            continue
        row = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))
        out = row if out is None else out.unionAll(row)
    absent = [name for name, df in tables.items() if df is None]
    if absent:
        names = F.array(*[F.lit(name) for name in absent])
        zero = spark.range(1).select(F.explode(names).alias("table_name"), F.lit(0).cast("bigint").alias("n"))
        out = zero if out is None else out.unionAll(zero)
    return out


def open_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table at ``path``, None if there is none."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException:
        return None


def json_records(spark: SparkSession, path: str, schema: T.StructType, lines: bool = False) -> int:
    """Number of records in a result file; 0 for one that is absent or cannot be read."""
    marked = T.StructType([*schema.fields, T.StructField("__bad", T.StringType())])
    try:
        rows = (
            spark.read.schema(marked)
            .option("multiLine", not lines)
            .option("columnNameOfCorruptRecord", "__bad")
            .json(path)
        )
        # The record itself is counted, so that Spark parses it and cannot skip the check.
        good = F.when(F.col("__bad").isNull(), F.struct(*schema.names))
        return rows.agg(F.count(good).alias("n")).first()["n"]
    except AnalysisException:
        return 0


def list_assets(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(name, length) of the files below ``folder``; their content is not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    return files.select(F.substring_index("path", "/", -1).alias("name"), "length")


def folder_size_mb(spark: SparkSession, folder: str) -> float:
    """Size of the files below ``folder`` in MB, two places; 0 for one that is absent."""
    try:
        total = list_assets(spark, folder).agg(F.sum("length").alias("bytes")).first()["bytes"]
    except AnalysisException:
        total = None
    return round((total or 0) / 1024 / 1024, 2)


def asset_manifest(expected: DataFrame, listing: DataFrame, min_bytes: int = 1024) -> DataFrame:
    """(name, length, status, accept_new) for every expected file.

    A file that is there is ``valid`` above ``min_bytes`` and else to ``refetch``; a file just
    fetched is accepted from ``min_bytes`` on, so the two differ at exactly that size.
    """
    length = F.col("length")
    return expected.join(listing.select("name", "length"), "name", "left").select(
        "name",
        "length",
        F.when(length.isNull(), F.lit("missing"))
        .when(length > min_bytes, F.lit("valid"))
        .otherwise(F.lit("refetch"))
        .alias("status"),
        F.coalesce(length >= min_bytes, F.lit(False)).alias("accept_new"),
    )
