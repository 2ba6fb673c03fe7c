"""Line dedup: lines that several documents share stay only in the first of them.

Lines are exploded with their place, normalised and hashed; one aggregation finds the hashes that
occur in two documents or more and the smallest document of each; the places to drop are gathered
per document, and each text is put together again from the places that stay. The text itself is
shuffled once, with its document, and never with its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_name, join_hot, stored, table
from .registry import ORACLE, QUERIES

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\f\r"


def text_lines(text: Column) -> Column:
    """The lines of a text; NULL and '' are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line without the ASCII white space at its ends, A-Z lower-cased."""
    return F.btrim(F.translate(line, UPPER, UPPER.lower()), F.lit(BLANKS))


def _keyed(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """One row per line with a key of at least ``min_chars`` code points: document, digest of the text, place, key."""
    return (
        # the digest is made once a text, before its lines come apart
        docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("digest"), text_lines(F.col(text)).alias("lines"))
        .select("id", "digest", F.posexplode("lines").alias("place", "line"))
        .select("id", "digest", "place", line_key(F.col("line")).alias("key"))
        .where(F.length("key") >= min_chars)
        .select("id", "digest", "place", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(2), "key").alias("h2"))
    )


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 10) -> DataFrame:
    """``docs`` with the kept text in ``text``, and ``n_lines`` (before) and ``n_dropped`` added.

    A line goes if its key has ``min_chars`` code points or more and stands in two documents or more,
    except in the document with the smallest id that holds it, where all its lines stay. Rows with
    the same id are one document; rows with NULL as id are one document that comes last. NULL and
    empty texts are one empty line and become ''. Repeated rows each get the same result. Other
    columns stay; columns called ``n_lines`` or ``n_dropped`` are replaced. An empty table stays empty.
    """
    own_id, own_digest, own_places, own_lines = map(fresh_name, ("id", "digest", "places", "lines"))
    keyed = _keyed(docs, doc_id, text, min_chars)
    shared = (
        keyed.groupBy("h1", "h2")
        .agg(
            F.min("id").alias("first"), F.max("id").alias("last"), F.bool_or(F.col("id").isNull()).alias("unnamed"),
            F.count(F.lit(1)).alias("rows"),
        )
        .where((F.col("first") != F.col("last")) | (F.col("unnamed") & F.col("first").isNotNull()))
        .select("h1", "h2", "first", "rows")
    )
    # a line of very many documents is dealt out by the texts' digests
    dropped = (
        join_hot(keyed, stored(shared, "shared"), ["h1", "h2"], "rows", "digest")
        .where(~F.col("id").eqNullSafe(F.col("first")))
        .groupBy(F.col("id").alias(own_id), F.col("digest").alias(own_digest))
        .agg(F.collect_set("place").alias(own_places))
    )
    joined = docs.join(
        dropped.hint("shuffle_hash"),
        F.col(doc_id).eqNullSafe(F.col(own_id)) & (F.xxhash64(text) == F.col(own_digest)),
        "left",
    )
    lines, places = F.col(own_lines), F.col(own_places)
    # the stretches between dropped lines: sorted places, each slice taken from the lines that are split once
    befores = F.concat(F.array(F.lit(-1)), places)
    afters = F.concat(places, F.array(F.size(lines)))
    kept = F.flatten(F.zip_with(befores, afters, lambda a, b: F.slice(lines, a + 2, b - a - 1)))
    joined = joined.withColumn(own_lines, text_lines(F.col(text))).withColumn(own_places, F.sort_array(own_places))
    return joined.select(
        *[F.col(c) for c in docs.columns if c not in (text, "n_lines", "n_dropped")],
        F.when(places.isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(F.array_join(kept, "\n")).alias(text),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size(places), F.lit(0)).cast("long").alias("n_dropped"),
    ).select(*[c for c in docs.columns if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES["op4_line_dedup"] = op4_line_dedup
ORACLE["op4_line_dedup"] = r"""
WITH listed AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM listed),
keyed AS (
  SELECT doc_id, place, line,
    trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM lines),
shared AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (
  SELECT k.doc_id, k.place, k.line, s.key IS NOT NULL AND k.doc_id <> s.first AS gone
  FROM keyed k LEFT JOIN shared s ON s.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
