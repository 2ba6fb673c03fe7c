"""Mixing sources to target weights by systematic sampling.

A source's target share is its weight's part of all words, held at ``most`` times what the source has;
the excess goes to the others by weight until none is above. Inside a source every document has the
same expected number of copies. The running sum of expected copies, in order of size, plus one random
offset per source crosses an integer for each copy taken, so that neighbours in size share the copies
evenly and the words taken stay within about one document of the target.

The running sum is a rank, so no source meets in one task: rows are range-partitioned by source, size
and id, written once, numbered inside their partition, and raised by the sizes of the partitions before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACE_CLASS, fresh_name, stored, table
from .registry import ORACLE, QUERIES

WEIGHTS = (1, 2, 3)
MOST = 3
GRID = 1 << 20  # offsets are multiples of 1 / GRID, so that sums with them are exact
WORD = rf"[^{SPACE_CLASS}]+"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from one row per source (source, source_size).

    Sources in code point order, NULL last, weigh ``weights`` in turn. The cap binds the sources with the
    least ``source_size`` per weight first: in that order a source is capped as long as its cap lies
    below its part of what the capped ones before it leave. One row per source: the windows over all
    sources see that small table only.
    """
    number = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (number % len(weights)).cast("int") + 1)
    weighed = sizes.select("source", "source_size", weight.cast("long").alias("weight"))
    ratio = F.col("source_size").cast("double") / F.col("weight")
    order = W.orderBy(ratio, F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    capped_before = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most
    left = weighed.select(
        "*",
        (F.sum("source_size").over(everything) - capped_before).alias("words_left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weight_left"),
    )
    cap = F.col("source_size") * most
    capped = cap * F.col("weight_left") < F.col("words_left") * F.col("weight")
    # the first source that is not capped sets the price of a unit of weight; from there on the price only falls
    price = F.col("words_left").cast("double") / F.col("weight_left")
    marked = left.select("*", F.when(~capped, price).alias("price"))
    return marked.select(
        "source", "source_size",
        F.when(F.max("price").over(everything).isNull(), cap.cast("double"))
        .otherwise(F.least(cap.cast("double"), F.max("price").over(everything) * F.col("weight"))).alias("target"),
    )


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, copies), one row per row of ``docs``.

    ``size`` counts the words of the whole text (NULL: 0), ``copies`` how often the mix takes the
    document, ``taken`` = ``copies * size``. No document is taken more than ``most`` times. NULL is a
    source of its own, after all others. Sources without words have target 0 and are not taken.
    Ties in size go by id (NULL first), then by text; rows equal in all of these are alike, so that it
    does not matter which of them is taken. Reruns agree for the same ``seed``. Other columns are not
    returned. An empty table gives no rows.
    """
    sized = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(text).alias("tie"),
    )
    order = [F.col("source").asc_nulls_last(), "size", "doc_id", "tie"]
    ranged = sized.repartitionByRange(*order).sortWithinPartitions(*order)
    part, place = fresh_name("part"), fresh_name("place")
    in_part = F.monotonically_increasing_id()
    placed = stored(
        ranged.select("doc_id", "source", "size", F.shiftright(in_part, 33).alias(part),
                      in_part.bitwiseAND(F.lit((1 << 33) - 1)).alias(place)),
        "mix",
    )
    # one row per source and partition: at most partitions + sources rows, since sources are ranges
    pieces = placed.groupBy("source", part).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("words"), F.min(place).alias("start")
    )
    targets = source_targets(pieces.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    earlier = W.partitionBy("source").orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    ranks = pieces.select(
        "source", part, (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("start")).alias("shift")
    )
    known = ranks.join(targets, ranks["source"].eqNullSafe(targets["source"])).select(
        ranks["source"].alias("own"), F.col(part).alias("own_part"), "shift", "source_size", "target"
    )
    joined = placed.join(known, placed["source"].eqNullSafe(known["own"]) & (placed[part] == known["own_part"]))
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit("")))), 1, 5), 16, 10)
    offset = drawn.cast("double") / GRID
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rank = F.col(place) + F.col("shift")
    copies = (F.floor(expected * (rank + 1) + offset) - F.floor(expected * rank + offset)).cast("long")
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", (copies * F.col("size")).alias("taken"),
        copies.alias("copies"),
    )


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: how often the mix takes each document, and its words."""
    return mix_sources(docs)


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


QUERIES["op3_source_mix"] = op3_source_mix
ORACLE["op3_source_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sums),
lefts AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER earlier, 0) AS words_left,
    sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS weight_left
  FROM weighed
  WINDOW earlier AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
price AS (
  SELECT max(words_left::DOUBLE / weight_left::DOUBLE) AS unit FROM lefts
  WHERE NOT (3 * source_size * weight_left < words_left * weight)),
targets AS (
  SELECT source, source_size, CASE WHEN unit IS NULL THEN (3 * source_size)::DOUBLE
    ELSE least((3 * source_size)::DOUBLE, unit * weight) END AS target
  FROM lefts, price),
ranked AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id NULLS FIRST) - 1 AS rank,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0 END AS expected,
    ('0x' || left(md5('0:' || coalesce(s.source, '')), 5))::BIGINT / 1048576.0::DOUBLE AS shift
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (floor(expected * (rank + 1) + shift) - floor(expected * rank + shift))::BIGINT * size AS taken
FROM ranked
"""
