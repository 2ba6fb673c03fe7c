"""Keys, relations, dedup, unions, nesting."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relate
from ..session import scratch_dir
from ..sources import files, sinks
from .base import query, table


@query(
    """
SELECT d.doc_id, d.lang, coalesce(CAST(l.quality AS VARCHAR), '') AS quality,
  coalesce(CAST(l.toxic AS VARCHAR), '') AS toxic
FROM documents d LEFT JOIN labels l USING (doc_id)
"""
)
def detail_merge(spark, sf):
    base = table(spark, sf, "documents").select("doc_id", "lang", F.lit("unset").alias("quality"))
    detail = table(spark, sf, "labels").select(
        "doc_id", F.col("quality").cast("string").alias("quality"), F.col("toxic").cast("string").alias("toxic")
    )
    return relate.override(base, detail, "doc_id", ["quality", "toxic"])


@query(
    """
SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN d.source ELSE concat('q', l.quality) END AS source
FROM documents d LEFT JOIN labels l USING (doc_id)
"""
)
def detail_merge_keep(spark, sf):
    base = table(spark, sf, "documents").select("doc_id", "source")
    detail = table(spark, sf, "labels").select(
        "doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("source")
    )
    return relate.override(base, detail, "doc_id", ["source"], missing=None)


def _parents(spark, sf):
    return table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


BUILDING = "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"


@query(f"SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_custkey IN {BUILDING}")
def fk_valid(spark, sf):
    return relate.fk_valid(_orders(spark, sf), _parents(spark, sf), ["o_custkey"])


@query(f"SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_custkey NOT IN {BUILDING}")
def fk_rejects(spark, sf):
    return relate.fk_rejects(_orders(spark, sf), _parents(spark, sf), ["o_custkey"])


@query(
    """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
"""
)
def cascade_delete(spark, sf):
    deleted = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    children = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return relate.cascade_delete(children, deleted, ["l_orderkey"])


@query("SELECT p_name, p_brand, count(*) AS n FROM part GROUP BY p_name, p_brand HAVING count(*) > 1")
def unique_violations(spark, sf):
    return relate.unique_violations(table(spark, sf, "part"), ["p_name", "p_brand"])


@query(
    """
WITH p AS (SELECT row_number() OVER (ORDER BY p_retailprice, p_partkey) AS id, p_partkey FROM part)
SELECT p.id, l.l_partkey, count(*) AS n FROM lineitem l JOIN p ON p.p_partkey = l.l_partkey GROUP BY ALL
"""
)
def surrogate_key(spark, sf):
    parents = relate.with_row_id(table(spark, sf, "part").select("p_retailprice", "p_partkey"), ["p_retailprice", "p_partkey"])
    # Children are counted by the natural key first; only the counts are joined.
    children = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return children.join(parents, F.col("l_partkey") == F.col("p_partkey")).select("id", "l_partkey", "n")


@query(
    """
SELECT p_partkey, id FROM (SELECT row_number() OVER (ORDER BY p_retailprice, p_partkey) AS id, p_partkey FROM part)
WHERE id <> p_partkey
"""
)
def surrogate_mismatch(spark, sf):
    parents = relate.with_row_id(table(spark, sf, "part").select("p_retailprice", "p_partkey"), ["p_retailprice", "p_partkey"])
    return relate.surrogate_mismatch(parents, "p_partkey")


@query(
    """
SELECT doc_id, lang, source, text FROM (
  SELECT *, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1
"""
)
def dedup_first(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    return relate.keep_first(docs, [*relate.text_key("text"), "lang"], ["doc_id"])


@query(
    """
SELECT doc_id, source, lang, text FROM (
  SELECT *, row_number() OVER (PARTITION BY concat(source, '_', lang, '_', left(text, 100)) ORDER BY doc_id) AS rn
  FROM documents WHERE length(text) > 0) WHERE rn = 1
"""
)
def comment_dedup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang", "text")
    return relate.dedup_reviews(docs, "source", "lang", "text", ["doc_id"])


@query("SELECT c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier")
def union_all(spark, sf):
    return relate.union_all(
        table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")),
        table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")),
    )


@query(
    """
SELECT c_acctbal AS balance, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, NULL AS suppkey FROM customer
UNION ALL SELECT s_acctbal, s_name, s_nationkey, NULL, CAST(s_suppkey AS VARCHAR) FROM supplier
"""
)
def union_by_name(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("suppkey"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("balance"),
    )
    return relate.union_sorted(customers, suppliers)


@query(
    """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
"""
)
def upsert_latest(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return relate.keep_last(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query(
    """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn <= 15
"""
)
def first_k_per_key(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return relate.first_k(events, ["user_id"], ["ts", "event_id"], 15).drop("ts")


PAGED = ["l_partkey", "l_linenumber", "l_orderkey", "l_suppkey", "l_shipdate", "l_extendedprice"]

# Page by page, as a reader does it: a page is opened while fewer than 15 rows were seen before.
PAGES_SQL = """
WITH sizes AS (SELECT l_partkey, l_linenumber, count(*) AS n FROM lineitem WHERE l_linenumber <= 3 GROUP BY ALL),
opened AS (SELECT l_partkey, l_linenumber, n FROM (
  SELECT *, coalesce(sum(n) OVER (PARTITION BY l_partkey ORDER BY l_linenumber
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sizes) WHERE before < 15)
"""


@query(
    PAGES_SQL
    + """
SELECT l_partkey, l_linenumber, l_orderkey, l_suppkey, l_extendedprice FROM (
  SELECT l.*, row_number() OVER (PARTITION BY l_partkey
    ORDER BY l_linenumber, l_orderkey, l_suppkey, l_shipdate, l_extendedprice) AS rn
  FROM lineitem l JOIN opened USING (l_partkey, l_linenumber)) WHERE rn <= 15
"""
)
def page_accumulate(spark, sf):
    items = table(spark, sf, "lineitem").select(*PAGED)
    order = ["l_orderkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
    return relate.accumulate_pages(items, ["l_partkey"], "l_linenumber", order).drop("l_shipdate")


@query(
    """
WITH RECURSIVE sizes AS (
  SELECT k.l_partkey, p.page, count(l.l_partkey) AS n FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_linenumber <= 3) k
  CROSS JOIN (SELECT unnest([1, 2, 3]) AS page) p
  LEFT JOIN lineitem l ON l.l_partkey = k.l_partkey AND l.l_linenumber = p.page GROUP BY ALL),
reading AS (
  SELECT l_partkey, page, n AS seen FROM sizes WHERE page = 1
  UNION ALL SELECT r.l_partkey, s.page, r.seen + s.n FROM reading r JOIN sizes s
    ON s.l_partkey = r.l_partkey AND s.page = r.page + 1 WHERE r.seen < 15)
SELECT l_partkey, CAST(max(page) AS INTEGER) AS pages_read, CAST(max(seen) AS BIGINT) AS rows_seen
FROM reading GROUP BY l_partkey
"""
)
def pages_read(spark, sf):
    return relate.pages_read(table(spark, sf, "lineitem").select("l_partkey", "l_linenumber"), ["l_partkey"], "l_linenumber")


@query(
    """
WITH p AS (SELECT row_number() OVER (ORDER BY page_id) AS movie_id, page_id, html FROM pages),
l AS (SELECT movie_id, page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)"', 1)) AS author,
  unnest(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)', 1)) AS content,
  generate_subscripts(regexp_extract_all(html, '<li><a href="([^"]*)"', 1), 1) AS position FROM p)
SELECT movie_id, CAST(position AS INTEGER) AS position, author, content FROM l
"""
)
def nested_fanout(spark, sf):
    pages = table(spark, sf, "pages")
    links = F.arrays_zip(
        F.regexp_extract_all("html", F.lit('<li><a href="([^"]*)"'), 1).alias("author"),
        F.regexp_extract_all("html", F.lit('<li><a href="[^"]*">([^<]*)'), 1).alias("content"),
    )
    items = relate.with_row_id(pages.select("page_id", links.alias("hot_comments")), ["page_id"], "movie_id")
    _, children = relate.split_nested(items, "hot_comments", "movie_id")
    return children


@query(
    """
SELECT text AS content FROM conversations WHERE length(text) > 0
"""
)
def text_source(spark, sf):
    """Texts of the flat table; those nested in pages would step in only if it held none."""
    pages = table(spark, sf, "pages").select(
        F.transform(
            F.regexp_extract_all("html", F.lit("<p>([^<]*)"), 1), lambda x: F.struct(x.alias("content"))
        ).alias("hot_comments")
    )
    return relate.texts_or_nested(table(spark, sf, "conversations"), "text", pages, "hot_comments", "content")


@query(
    """
SELECT content FROM (SELECT unnest(regexp_extract_all(html, '<p>([^<]*)', 1)) AS content FROM pages)
WHERE length(content) > 0
"""
)
def text_source_nested(spark, sf):
    """The same with a flat table whose texts are all empty."""
    pages = table(spark, sf, "pages").select(
        F.transform(
            F.regexp_extract_all("html", F.lit("<p>([^<]*)"), 1), lambda x: F.struct(x.alias("content"))
        ).alias("hot_comments")
    )
    empty = table(spark, sf, "conversations").withColumn("text", F.lit(""))
    return relate.texts_or_nested(empty, "text", pages, "hot_comments", "content")


@query("PIVOT (SELECT event_id, event_type, CAST(user_id AS VARCHAR) AS user_id FROM events) ON event_type USING first(user_id) GROUP BY event_id")
def open_header(spark, sf):
    """A CSV whose header is the keys found in the data, written and read back."""
    record = F.to_json(F.map_from_arrays(F.array("event_type"), F.array("user_id"))).alias("record")
    opened = relate.open_columns(table(spark, sf, "events").where("event_type IS NOT NULL").select("event_id", record), "record")
    path = scratch_dir(spark, "open_header")
    sinks.write_csv(opened, path)
    back = files.read_csv(spark, path, multi_line=False)
    return back.withColumn("event_id", F.col("event_id").cast("long"))


@query("SELECT c_custkey, c_name, 'keys, limits, nulls' AS refused FROM customer")
def load_refused(spark, sf):
    """A stored table after three loads that were refused for repeated keys, long texts and NULLs: all rows are as before."""
    path = scratch_dir(spark, "refused")
    held = table(spark, sf, "customer").select("c_custkey", "c_name")
    sinks.replace_table(held, path, ["c_custkey"], "20240101_120000", {"c_name": 100}, ["c_custkey"])
    missing = held.unionByName(held.select(F.lit(None).cast("bigint").alias("c_custkey"), "c_name").limit(1))
    refused = []
    for name, load, limits in (("keys", held.unionByName(held), {}), ("limits", held, {"c_name": 5}), ("nulls", missing, {"c_name": 100})):
        try:
            sinks.replace_table(load, path, ["c_custkey"], "20240102_120000", limits, ["c_custkey"])
        except sinks.ConstraintError:
            refused.append(name)
    return sinks.read_latest_run(spark, path).select("c_custkey", "c_name", F.lit(", ".join(refused)).alias("refused"))
