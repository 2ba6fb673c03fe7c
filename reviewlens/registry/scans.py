"""Scans and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import relate
from ..operators.stats import StageMetrics
from ..operators.stats import stage_counts as count_stages
from ..session import scratch_dir
from ..sources import files, sinks
from .base import TABLES, query, table


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def json_roundtrip(spark, sf):
    docs = table(spark, sf, "documents")
    path = scratch_dir(spark, "json")
    sinks.write_json(docs, path)
    return files.read_json(spark, path, docs.schema)


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_roundtrip(spark, sf):
    docs = table(spark, sf, "documents")
    path = scratch_dir(spark, "csv")
    sinks.write_csv(docs, path)
    return files.read_csv(spark, path, docs.schema)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def table_replace(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    path = scratch_dir(spark, "table")
    sinks.replace_table(orders.where("o_orderstatus = 'F'"), path, ["o_orderkey"], "20240101_000000")
    sinks.replace_table(orders, path, ["o_orderkey"], "20240102_000000")
    return sinks.read_latest_run(spark, path).drop("run_ts")


@query(
    """
WITH t AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey),
s AS (SELECT l_suppkey, n, unnest(generate_series(0, least(250, n) - 1, 25)) AS start FROM t)
SELECT l_suppkey, n, CAST(start AS INTEGER) AS start,
  concat('https://movies.example.com/top?start=', start, '&filter=') AS url
FROM s
"""
)
def page_offsets(spark, sf):
    totals = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return files.page_offsets(totals, "n", "https://movies.example.com/top?start=%d&filter=")


@query(
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES)
    + " UNION ALL SELECT 'absent', 0"
)
def table_counts(spark, sf):
    tables = {t: files.open_parquet(spark, f"{sf}/{t}.parquet") for t in [*TABLES, "absent"]}
    return files.table_counts(spark, tables)


@query(
    """
WITH d AS (SELECT d.text, d.lang, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)),
t AS (SELECT * FROM d WHERE length(text) > 0)
SELECT 'read' AS stage, '' AS column_name, count(*) AS n FROM d
UNION ALL SELECT 'read', 'text', count(*) FILTER (text IS NULL) FROM d
UNION ALL SELECT 'read', 'quality', count(*) FILTER (quality IS NULL) FROM d
UNION ALL SELECT 'with_text', '', count(*) FROM t
UNION ALL SELECT 'with_text', 'lang', count(*) FILTER (lang IS NULL) FROM t
UNION ALL SELECT 'unique', '', count(DISTINCT text) FROM t
"""
)
def stage_metrics(spark, sf):
    """Rows and NULLs of the stages of one cleaning run, counted while its result is written."""
    run = StageMetrics()
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    docs = run.watch(table(spark, sf, "documents").join(labels, "doc_id", "left"), "read", ["text", "quality"])
    held = run.watch(docs.where(F.length("text") > 0), "with_text", ["lang"])
    unique = run.watch(relate.keep_first(held, relate.text_key("text"), ["doc_id"]), "unique")
    unique.write.parquet(scratch_dir(spark, "metrics"))
    return run.report(spark)


@query(
    """
SELECT 'read' AS stage, count(*) AS n FROM documents
UNION ALL SELECT 'with_text', count(*) FROM documents WHERE length(text) > 0
UNION ALL SELECT 'unique', count(DISTINCT text) FROM documents WHERE length(text) > 0
UNION ALL SELECT 'labelled', count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
"""
)
def stage_counts(spark, sf):
    docs = table(spark, sf, "documents")
    with_text = docs.where(F.length("text") > 0)
    return count_stages(
        {
            "read": docs,
            "with_text": with_text,
            "unique": with_text.select(F.sha2("text", 256)).distinct(),  # far shorter than the texts
            "labelled": docs.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi"),
        }
    )


@query(
    """
WITH p AS (SELECT concat(page_id, '.html') AS name, url, octet_length(encode(html)) AS length FROM pages),
j AS (SELECT e.name, l.length FROM p e LEFT JOIN (SELECT name, length FROM p WHERE url LIKE 'https%') l USING (name))
SELECT name, coalesce(length, -1) AS length,
  CASE WHEN length IS NULL THEN 'missing' WHEN length > 4096 THEN 'valid' ELSE 'refetch' END AS status,
  coalesce(length >= 4096, false) AS accept_new
FROM j
"""
)
def asset_manifest(spark, sf):
    pages = table(spark, sf, "pages").withColumn("name", F.concat(F.col("page_id").cast("string"), F.lit(".html")))
    listing = pages.where(F.col("url").startswith("https")).select(
        "name", F.octet_length("html").cast("bigint").alias("length")
    )
    return files.asset_manifest(pages.select("name"), listing, 4096).na.fill({"length": -1})


CONTENT_TYPES = ["image/jpeg", "image/png; q=1", "image/webp", "image/gif", "text/html", "image/jpg"]


@query(
    f"""
WITH t AS (SELECT page_id, list_extract([{", ".join(f"'{c}'" for c in CONTENT_TYPES)}],
  CAST(length(url) % {len(CONTENT_TYPES)} + 1 AS BIGINT)) AS content_type FROM pages)
SELECT page_id, content_type, regexp_matches(content_type, 'image/(jpeg|png|webp)') AS is_image,
  CASE WHEN content_type LIKE '%jpeg%' OR content_type LIKE '%jpg%' THEN '.jpg'
       WHEN content_type LIKE '%png%' THEN '.png' WHEN content_type LIKE '%webp%' THEN '.webp'
       ELSE '.jpg' END AS extension
FROM t
"""
)
def asset_extension(spark, sf):
    kinds = F.array(*[F.lit(c) for c in CONTENT_TYPES])
    typed = table(spark, sf, "pages").select(
        "page_id", F.get(kinds, F.length("url") % len(CONTENT_TYPES)).alias("content_type")
    )
    kind = F.col("content_type")
    return typed.select(
        "page_id", "content_type", names.is_image(kind).alias("is_image"), names.extension(kind).alias("extension")
    )


@query("SELECT o_orderkey, o_totalprice, '20240102_120000' AS run_ts FROM orders WHERE o_orderstatus <> 'F'")
def run_partition_latest(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = scratch_dir(spark, "runs")
    sinks.write_run(orders.where("o_orderstatus = 'F'").drop("o_orderstatus"), path, "20240101_120000")
    sinks.write_run(orders.where("o_orderstatus <> 'F'").drop("o_orderstatus"), path, "20240102_120000")
    return sinks.read_latest_run(spark, path)


@query(
    """
WITH e AS (SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id, value, event_type,
    CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS src FROM events)
SELECT event_id, user_id, value, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY src DESC, event_id DESC) AS rn FROM e)
WHERE user_id IS NULL OR (src = 1 AND rn = 1)
  OR (src = 0 AND user_id NOT IN (SELECT user_id FROM e WHERE src = 1 AND user_id IS NOT NULL))
"""
)
def upsert_merge(spark, sf):
    """Some events have no user: they replace nothing and all stay."""
    user = F.when(F.col("event_id") % 11 != 0, F.col("user_id").cast("string")).alias("user_id")
    events = table(spark, sf, "events").select("event_id", user, "value", "event_type")
    views = F.col("event_type") == "view"
    return sinks.upsert(events.where(~views), events.where(views), ["user_id"], ["event_id"])


@query(
    """
SELECT doc_id AS movie_id, lang AS username, text AS content FROM documents
WHERE doc_id IN (SELECT doc_id FROM labels)
"""
)
def comments_for_load(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("movie_rank"), F.col("lang").alias("username"), F.col("text").alias("content")
    )
    parents = table(spark, sf, "labels").select(F.col("doc_id").alias("rank_num"))
    return sinks.comments_for_load(docs, parents)
