"""Keys and relations: first and last per key, ids, overrides, foreign keys.

Per-key limits are written as ``row_number() <= k``. Spark then keeps at most k rows per key in
every map task before the shuffle (WindowGroupLimit), so a key that holds a third of the table
reaches its reducer as k rows per map task and not as a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import freeze

Keys = Sequence[str | Column]


def _columns(cols: Keys) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def first_k(df: DataFrame, keys: Keys, order_by: Keys, k: int) -> DataFrame:
    """The first ``k`` rows of each key."""
    window = W.partitionBy(*_columns(keys)).orderBy(*_columns(order_by))
    return df.withColumn("__rank", F.row_number().over(window)).where(F.col("__rank") <= k).drop("__rank")


def keep_first(df: DataFrame, keys: Keys, order_by: Keys) -> DataFrame:
    """One row per key, the first in ``order_by``."""
    return first_k(df, keys, order_by, 1)


def keep_last(df: DataFrame, keys: Keys, order_by: Keys) -> DataFrame:
    """One row per key, the last in ``order_by``, with all its columns (its NULLs too)."""
    return first_k(df, keys, [c.desc_nulls_last() for c in _columns(order_by)], 1)


def has_null(keys: Keys) -> Column:
    """Whether one of the key columns is NULL."""
    return reduce(lambda a, b: a | b, [c.isNull() for c in _columns(keys)])


def keep_last_named(df: DataFrame, keys: Keys, order_by: Keys) -> DataFrame:
    """As ``keep_last``, but rows with a NULL in their key all stay, as a UNIQUE column keeps them."""
    # such a row is a key of its own, so that one pass serves all rows and no task gathers those
    alone = F.when(has_null(keys), F.monotonically_increasing_id())
    return keep_last(df.withColumn("__alone", alone), [*keys, "__alone"], order_by).drop("__alone")


def text_key(col: str) -> list[Column]:
    """Digest and length of a text: a key that shuffles and sorts without the text itself."""
    return [F.sha2(col, 256), F.length(col)]


def review_key(rank: str, user: str, content: str, width: int = 100) -> Column:
    """Movie, user and first ``width`` characters of a review as one text."""
    empty = F.lit("")
    return F.concat_ws(
        "_",
        F.coalesce(F.col(rank).cast("string"), empty),
        F.coalesce(F.col(user), empty),
        F.left(F.col(content), F.lit(width)),
    )


def dedup_reviews(df: DataFrame, rank: str, user: str, content: str, order_by: Keys, width: int = 100) -> DataFrame:
    """Reviews with text, the first one per ``review_key``."""
    return keep_first(df.where(F.length(content) > 0), [review_key(rank, user, content, width)], order_by)


def accumulate_pages(
    df: DataFrame, keys: Keys, page: str, order_by: Keys, cap: int = 15, max_pages: int = 3
) -> DataFrame:
    """Rows read page by page until ``cap`` is reached, from at most ``max_pages`` pages, cut to ``cap``.

    A page is opened only while fewer than ``cap`` rows are there, so the rows kept are the first
    ``cap`` in page order.
    """
    return first_k(df.where(F.col(page) <= max_pages), keys, [page, *order_by], cap)


def pages_read(df: DataFrame, keys: Sequence[str], page: str, cap: int = 15, max_pages: int = 3) -> DataFrame:
    """(keys, pages_read, rows_seen): how far the reading of ``accumulate_pages`` went.

    One sum per page number, so the rows of a key meet only as ``max_pages`` partial counts.
    """
    sizes = df.where(F.col(page).between(1, max_pages)).groupBy(*keys)
    counted = sizes.agg(*[F.count_if(F.col(page) == p).alias(f"__p{p}") for p in range(1, max_pages + 1)])
    opened, seen = F.lit(0), F.lit(0).cast("bigint")
    for p in range(1, max_pages + 1):
        goes_on = seen < cap
        opened = F.when(goes_on, F.lit(p)).otherwise(opened)
        seen = F.when(goes_on, seen + F.col(f"__p{p}")).otherwise(seen)
    return counted.select(*keys, opened.alias("pages_read"), seen.alias("rows_seen"))


def with_row_id(df: DataFrame, order_by: Sequence[str], name: str = "id") -> DataFrame:
    """Gap-free ids 1..n in the order of ``order_by`` (which must be unique), without one global sort task.

    Rows are range-partitioned and frozen; a row's id is its place in the partition plus the sizes
    of the partitions before it. The offsets have one row per shuffle partition, however large
    ``df`` is, which bounds both their window and their broadcast.
    """
    return number_rows(df.repartitionByRange(*order_by).sortWithinPartitions(*order_by), name)


def number_rows(df: DataFrame, name: str = "id") -> DataFrame:
    """Gap-free ids 1..n in the order in which the rows come: of a file, its own order. Frozen once."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = freeze(df.withColumn("__part", F.spark_partition_id()).withColumn("__place", place))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("__size"))
        .select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__place") + F.col("__offset") + 1)
        .select(name, *df.columns)
    )


def override(base: DataFrame, detail: DataFrame, on: str, cols: Sequence[str], missing: str | None = "") -> DataFrame:
    """``base`` with ``cols`` taken from ``detail``; where a detail row lacks a value: ``missing``.

    With ``missing=None`` the value of ``base`` stays instead. ``detail`` has one row per key.
    """
    picked = detail.select(on, *[F.col(c).alias(f"__{c}") for c in cols])
    joined = base.join(picked, on, "left")
    kept = [F.col(c) for c in base.columns if c not in cols]
    for c in cols:
        own = F.col(c) if c in base.columns else F.lit(None).cast("string")
        fallback = own if missing is None else F.lit(missing)
        kept.append(F.coalesce(F.col(f"__{c}"), fallback).alias(c))
    return joined.select(*kept)


def fk_valid(child: DataFrame, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    """Child rows whose parent exists."""
    return child.join(parent.select(*on), list(on), "left_semi")


def fk_rejects(child: DataFrame, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    """Child rows without a parent, those with a NULL key among them."""
    return child.join(parent.select(*on), list(on), "left_anti")


def cascade_delete(child: DataFrame, deleted: DataFrame, on: Sequence[str]) -> DataFrame:
    """Child rows left after the parents in ``deleted`` are gone."""
    return fk_rejects(child, deleted, on)


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n) for keys on more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def surrogate_mismatch(parent: DataFrame, rank: str, id_col: str = "id") -> DataFrame:
    """Parents whose id is not their rank, so children that store the rank would miss them."""
    return parent.where(F.col(rank).cast("bigint") != F.col(id_col)).select(rank, id_col)


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of frames with the same columns."""
    return reduce(DataFrame.unionAll, frames)


def union_sorted(*frames: DataFrame) -> DataFrame:
    """All rows; the columns are the sorted union of names, NULL where a frame lacks one."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return merged.select(*sorted(merged.columns))


def open_columns(df: DataFrame, record: str) -> DataFrame:
    """``df`` with a text column for each key that the JSON objects in ``record`` hold, instead of ``record``.

    The header is the sorted union of the keys in the data, gathered by an aggregation; no schema names them beforehand. Values that are
    objects or arrays stay JSON text. A key called like a column of ``df`` is left to that column.
    """
    held = df.withColumn("__record", F.try_variant_get(F.try_parse_json(record), "$", "map<string,variant>"))
    keys = df.select(F.explode(F.json_object_keys(record)).alias("key")).distinct()
    header = sorted(r["key"] for r in keys.collect() if r["key"] not in df.columns)  # a table's header
    rest = [c for c in df.columns if c != record]
    value = lambda key: F.try_variant_get(F.try_element_at("__record", F.lit(key)), "$", "string")
    return held.select(*rest, *(value(k).alias(k) for k in header))


def split_nested(df: DataFrame, array_col: str, parent_key: str) -> tuple[DataFrame, DataFrame]:
    """(parents without the array, one child row per array element with the parent's key)."""
    children = df.select(parent_key, F.posexplode(array_col).alias("position", "__item")).select(
        parent_key, (F.col("position") + 1).alias("position"), "__item.*"
    )
    return df.drop(array_col), children


def texts_or_nested(reviews: DataFrame, content: str, items: DataFrame, array_col: str, field: str) -> DataFrame:
    """Review texts; those nested in ``items`` only where ``reviews`` holds no text at all."""
    own = reviews.where(F.length(content) > 0).select(F.col(content).alias("content"))
    nested = items.select(F.explode(array_col).alias("__item")).select(
        F.col("__item").getField(field).alias("content")
    )
    none_own = own.agg((F.count(F.lit(1)) == 0).alias("none")).scalar()
    return own.unionAll(nested.where((F.length("content") > 0) & none_own))
