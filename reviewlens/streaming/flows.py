"""Item flows: file streams into validated, deduplicated, upserted and capped tables.

Keyed results are kept as one folder per micro-batch and resolved on reading. A batch is committed by
one entry in a manifest once all of its sinks are written, and readers take the folders of committed
batches only, so all sinks show the same batches; a replayed batch
overwrites its own folder, so the sinks are idempotent; no batch rewrites what earlier ones wrote;
and a key with a large share of the rows is cut down in every map task by the same per-key limits
as in batch. ``compact`` folds the folders into one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from types import MappingProxyType

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.relate import accumulate_pages, keep_first, keep_last_named, with_row_id
from ..operators.validate import validate
from ..session import settings_of
from ..sources.files import open_parquet
from ..sources.sinks import Writer, fan_out

BATCH = "batch_id"
MAX_FILES = 256  # new files a micro-batch takes, so that a backlog is worked off in bounded batches
ALL_FILES = (1 << 31) - 1  # a micro-batch of all new files


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int = MAX_FILES
) -> DataFrame:
    """New files below a folder or matching a pattern, or one file, as a stream of at most ``max_files`` files a batch."""
    reader = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files)
    # A stream takes a single file only as a pattern; this one stands for the path itself.
    return reader.load(path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]")


def _run(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _store(df: DataFrame, target: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{target}/{BATCH}={batch_id}")


def _manifest(target: str) -> str:
    return f"{target}_commits"


def commit(spark: SparkSession, target: str, batch_id: int) -> None:
    """Enter a batch whose sinks are all written in the manifest of ``target``; once more changes nothing."""
    spark.range(1).select(F.lit(batch_id).cast("long").alias(BATCH)).write.mode("overwrite").json(f"{_manifest(target)}/n={batch_id}")


def committed_batches(spark: SparkSession, target: str) -> DataFrame:
    """(batch_id) of the committed batches of ``target``."""
    try:
        return spark.read.schema(f"{BATCH} long").json(f"{_manifest(target)}/*").distinct()
    except AnalysisException:  # none yet
        return spark.createDataFrame([], f"{BATCH} long")


def read_committed(spark: SparkSession, target: str, path: str | None = None, fmt: str = "parquet", schema: T.StructType | None = None,
                   **options: object) -> DataFrame:
    """The rows that the committed batches of ``target`` left in the sink ``path`` (default: the table itself), with their batch_id.

    A batch that is written in part, or that some sinks hold and others do not, is left out until it is committed.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())]))
    rows = reader.load(path or target).withColumn(BATCH, F.col(BATCH).cast("long"))
    return rows.join(committed_batches(spark, target), BATCH, "left_semi")


def reduced_stream(
    stream: DataFrame,
    target: str,
    reduce: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    sinks: Sequence[Callable[[int], Writer]] = (),
    prepare: Callable[[DataFrame, int], DataFrame] | None = None,
) -> StreamingQuery:
    """Each micro-batch cut down by ``reduce`` and stored in its own folder, committed when all sinks hold it.

    ``reduce`` must give the same when applied to batches and then to their union, as limits per key
    do. ``sinks`` give further writers for a batch number; they get every row of the batch, in the
    given order after the table itself. ``prepare`` changes a batch before any of them gets it; for one batch number it must always
    give the same.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        def table(df: DataFrame) -> None:
            _store(reduce(df), target, batch_id)

        batch = prepare(batch, batch_id) if prepare else batch
        if sinks:
            fan_out(batch, [table, *[sink(batch_id) for sink in sinks]])
        else:
            table(batch)
        commit(batch.sparkSession, target, batch_id)

    return _run(stream, step, checkpoint)


def number_keys(batch: DataFrame, batch_id: int, ids: str, key: str, name: str) -> DataFrame:
    """``batch`` with the number of its ``key`` as ``name``: that of an earlier batch, or a new one above the highest.

    ``ids`` holds a folder of new keys per batch. A replayed batch sees the batches before it alone and gives its keys the
    same numbers again, in the order of the keys; a number never changes. NULL keys have none.
    """
    spark = batch.sparkSession
    schema = T.StructType([batch.schema[key], T.StructField(name, T.LongType()), T.StructField(BATCH, T.LongType())])
    known = open_parquet(spark, ids, schema)
    keys = batch.where(F.col(key).isNotNull()).select(key).distinct()
    highest = 0
    if known is not None:
        known = known.where(F.col(BATCH) < batch_id).drop(BATCH)
        keys = keys.join(known, key, "left_anti")
        highest = known.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
    fresh = with_row_id(keys, [key], name).withColumn(name, F.col(name) + highest).select(key, name)
    _store(fresh, ids, batch_id)
    mine = spark.read.schema(T.StructType(schema.fields[:2])).parquet(f"{ids}/{BATCH}={batch_id}")
    every = mine if known is None else known.select(key, name).unionByName(mine)
    return batch.join(every, key, "left")


def upsert_stream(
    stream: DataFrame,
    target: str,
    keys: Sequence[str],
    order_by: Sequence,
    checkpoint: str,
    sinks: Sequence[Callable[[int], Writer]] = (),
    prepare: Callable[[DataFrame, int], DataFrame] | None = None,
) -> StreamingQuery:
    """Last row per key, whole rows replaced; rows with a NULL in their key all stay."""
    return reduced_stream(stream, target, lambda df: keep_last_named(df, keys, order_by), checkpoint, sinks, prepare)


def read_upserted(spark: SparkSession, target: str, keys: Sequence[str], order_by: Sequence) -> DataFrame:
    """The table behind ``upsert_stream``: a later batch wins, within a batch the last row."""
    rows = read_committed(spark, target)
    return keep_last_named(rows, keys, [F.col(BATCH), *order_by]).drop(BATCH)


def accumulate_stream(
    stream: DataFrame,
    target: str,
    keys: Sequence[str],
    page: str,
    order_by: Sequence[str],
    checkpoint: str,
    cap: int = 15,
    max_pages: int = 3,
) -> StreamingQuery:
    """At most ``cap`` rows per key from its first ``max_pages`` pages.

    The state of a key is its first ``cap`` rows of each batch, so it does not grow with the batch.
    """
    return reduced_stream(
        stream, target, lambda df: accumulate_pages(df, keys, page, order_by, cap, max_pages), checkpoint
    )


def read_accumulated(
    spark: SparkSession,
    target: str,
    keys: Sequence[str],
    page: str,
    order_by: Sequence[str],
    cap: int = 15,
    max_pages: int = 3,
) -> DataFrame:
    """The rows kept over all batches; the first ``cap`` overall are among those of each batch."""
    return accumulate_pages(read_committed(spark, target).drop(BATCH), keys, page, order_by, cap, max_pages)


def first_stream(
    stream: DataFrame, target: str, keys: Sequence, order_by: Sequence, checkpoint: str
) -> StreamingQuery:
    """First row per key: dedup with a known survivor."""
    return reduced_stream(stream, target, lambda df: keep_first(df, keys, order_by), checkpoint)


def read_first(spark: SparkSession, target: str, keys: Sequence, order_by: Sequence) -> DataFrame:
    """The table behind ``first_stream``: an earlier batch wins, within a batch the first row."""
    return keep_first(read_committed(spark, target), keys, [F.col(BATCH), *order_by]).drop(BATCH)


def compact(table: DataFrame, new_target: str) -> None:
    """Write the resolved ``table`` to a new folder, as a batch before all others.

    A stream stopped before and started again on ``new_target`` with its old checkpoint goes on there.
    """
    _store(table, new_target, -1)
    commit(table.sparkSession, new_target, -1)


def dedup_stream(
    stream: DataFrame, keys: Sequence[str], spread: Column | None = None, salts: int = 16,
    event_time: str | None = None, delay: str | None = None,
) -> DataFrame:
    """One row per key over the whole stream, which one is open.

    With ``event_time`` and ``delay`` keys are forgotten once they are that old, which bounds the
    state. With ``spread`` (a column that varies among the copies of a key) copies meet in two
    steps, first within one of ``salts`` parts of a key and then as one row per part.
    """
    keys = list(keys)
    if event_time is not None:
        stream = stream.withWatermark(event_time, delay)

    def distinct(df: DataFrame, by: list[str]) -> DataFrame:
        return df.dropDuplicatesWithinWatermark(by) if event_time is not None else df.dropDuplicates(by)

    if spread is None:
        return distinct(stream, keys)
    salted = stream.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    return distinct(distinct(salted, [*keys, "__salt"]).drop("__salt"), keys)


def validate_stream(stream: DataFrame, required: Sequence[str], number: str, low: float = 0, high: float = 10) -> DataFrame:
    """Rows with their ``flags``; none is dropped."""
    return validate(stream, required, number, low, high)


def to_files(stream: DataFrame, target: str, checkpoint: str, settings: Mapping[str, str] = MappingProxyType({})) -> StreamingQuery:
    """Append a stream to Parquet files, each row once; ``settings`` hold for this stream, whatever the session has."""
    writer = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    # a stream takes a copy of the session's settings when it is started
    with settings_of(stream.sparkSession, settings):
        return writer.start()
