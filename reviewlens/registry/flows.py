"""Streaming twins: the tables as file streams of several batches, run until their end, all sinks read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relate
from ..plans import items
from ..session import scratch_dir
from ..sources import sinks
from ..streaming import flows, state
from .base import ORACLE, query, table
from .relations import PAGED, PAGES_SQL


def _stream(spark, sf, name):
    return flows.file_stream(spark, f"{sf}/{name}.parquet", table(spark, sf, name).schema)


def _deliver(df, folder, part, numbers, run, write=None):
    """The rows with ``part`` = each of ``numbers`` arrive one after the other, in as many files as there are tasks, and ``run`` takes each as one micro-batch."""
    for number in numbers:
        rows = df.where(part == number)
        write(rows, f"{folder}/{number:03d}") if write else rows.write.parquet(f"{folder}/{number:03d}")
        run()


def _arrived(df, folder):
    """All that has arrived in ``folder`` as a stream that takes it at once."""
    return flows.file_stream(df.sparkSession, f"{folder}/*", df.schema, max_files=flows.ALL_FILES)


def _days(events, days):
    return F.floor(F.datediff("ts", F.lit("2024-01-01")) / days)


@query(
    """
WITH e AS (SELECT CASE WHEN event_id % 11 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id, event_id, event_type, value, ts FROM events)
SELECT user_id, event_id, event_type, value, 1 AS n_json, 1 AS n_csv FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM e)
WHERE rn = 1 OR user_id IS NULL
"""
)
def stream_upsert(spark, sf):
    """Five batches into a keyed table, JSON and CSV; every row must stand once in both exports."""
    root = scratch_dir(spark, "upsert")
    user = F.when(F.col("event_id") % 11 != 0, F.col("user_id").cast("string")).alias("user_id")
    rows = table(spark, sf, "events").select(user, "event_id", "event_type", "value", "ts")

    def to_json(batch_id):
        return lambda df: sinks.write_json(df, f"{root}/json/batch_id={batch_id}")

    def to_csv(batch_id):
        return lambda df: sinks.write_csv(df, f"{root}/csv/batch_id={batch_id}")

    keys, order = ["user_id"], ["ts", "event_id"]

    def run():
        events = _arrived(rows, f"{root}/in")
        flows.upsert_stream(events, f"{root}/table", keys, order, f"{root}/checkpoint", [to_json, to_csv]).awaitTermination()

    _deliver(rows, f"{root}/in", _days(rows, 6), range(5), run)
    held = flows.read_upserted(spark, f"{root}/table", keys, order).drop("ts")
    for name, options in (("json", {}), ("csv", {"header": True})):
        export = flows.read_committed(spark, f"{root}/table", f"{root}/{name}", name, **options)
        counts = export.groupBy(F.col("event_id").cast("long").alias("event_id")).agg(F.count(F.lit(1)).cast("int").alias(f"n_{name}"))
        held = held.join(counts, "event_id", "left")
    return held


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, sf):
    root = scratch_dir(spark, "dedup")
    events = _stream(spark, sf, "events").select("user_id", "event_type", "event_id")
    unique = flows.dedup_stream(events, ["user_id", "event_type"], spread=F.col("event_id")).drop("event_id")
    flows.to_files(unique, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query(ORACLE["comment_dedup"])
def stream_first(spark, sf):
    root = scratch_dir(spark, "first")
    docs = _stream(spark, sf, "documents").select("doc_id", "source", "lang", "text").where(F.length("text") > 0)
    key = [relate.review_key("source", "lang", "text")]
    flows.first_stream(docs, f"{root}/table", key, ["doc_id"], f"{root}/checkpoint").awaitTermination()
    return flows.read_first(spark, f"{root}/table", key, ["doc_id"])


@query(ORACLE["page_accumulate"])
def stream_accumulate(spark, sf):
    root = scratch_dir(spark, "accumulate")
    items = _stream(spark, sf, "lineitem").select(*PAGED)
    keys, page, order = ["l_partkey"], "l_linenumber", ["l_orderkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
    flows.accumulate_stream(items, f"{root}/table", keys, page, order, f"{root}/checkpoint").awaitTermination()
    return flows.read_accumulated(spark, f"{root}/table", keys, page, order).drop("l_shipdate")


@query(
    """
SELECT event_id, value, array_to_string(list_filter([
  CASE WHEN coalesce(event_type, '') = '' THEN 'missing:event_type' END,
  CASE WHEN value < 0 OR value > 10 THEN 'range:value' END], lambda x: x IS NOT NULL), ',') AS flags FROM events
"""
)
def stream_validation(spark, sf):
    root = scratch_dir(spark, "validation")
    events = _stream(spark, sf, "events").select("event_id", "event_type", "value")
    checked = flows.validate_stream(events, ["event_type"], "value")
    out = checked.select("event_id", "value", F.array_join("flags", ",").alias("flags"))
    flows.to_files(out, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query(
    """
WITH i AS (SELECT page_id, url, regexp_extract(html, '<title>([^<]*)', 1) AS title,
  len(regexp_extract_all(html, '<li><a href="[^"]*">[^<]*')) AS n FROM pages),
k AS (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id % 4 DESC, page_id DESC) AS rn,
    min(page_id % 4) OVER (PARTITION BY url) AS arrived, sum(n) OVER (PARTITION BY url) AS exported, count(*) OVER (PARTITION BY url) AS items
  FROM i)
SELECT row_number() OVER (ORDER BY arrived, url) AS id, url AS detail_link, CAST(page_id AS VARCHAR) AS rank,
  CASE WHEN n % 2 = 0 THEN 'missing:title_cn' ELSE '' END AS flags, n AS comments,
  CAST(exported AS BIGINT) AS csv_comments, items AS json_items
FROM k WHERE rn = 1
"""
)
def item_flow(spark, sf):
    """Nested items in four batches: flagged, numbered at first arrival, upserted by link, exported, split into movies and reviews.

    ``csv_comments`` and ``json_items`` come from the exports of all batches, by the number and the link they carry.
    """
    root = scratch_dir(spark, "items")
    links = F.transform(
        F.regexp_extract_all("html", F.lit('<li><a href="([^"]*)"'), 1),
        lambda x: F.struct(
            x.alias("author"), F.lit("").alias("score"), F.lit("").alias("time"), F.lit("text").alias("content")
        ),
    )
    page = table(spark, sf, "pages").select(
        F.col("page_id").cast("string").alias("rank"),
        F.when(F.size(links) % 2 != 0, F.regexp_extract("html", "<title>([^<]*)", 1)).alias("title_cn"),
        F.lit("9.5").alias("rating"),
        F.col("url").alias("detail_link"),
        F.lpad(F.col("page_id").cast("string"), 20, "0").alias("crawled_at"),
        links.alias("hot_comments"),
    )

    def run():
        items.store_items(items.item_stream(spark, f"{root}/in/*", flows.ALL_FILES), f"{root}/out").awaitTermination()

    _deliver(page, f"{root}/in", F.col("rank").cast("long") % 4, range(4), run, sinks.write_json)
    movies, comments = items.read_items(spark, f"{root}/out")
    counts = comments.groupBy(F.col("movie_id").alias("id")).agg(F.count(F.lit(1)).alias("comments"))
    exported, written = items.read_exports(spark, f"{root}/out")
    in_csv = written.groupBy(F.col("movie_id").alias("id")).agg(F.count(F.lit(1)).alias("csv_comments"))
    in_json = exported.groupBy("detail_link").agg(F.count(F.lit(1)).alias("json_items"))
    return movies.join(counts, "id", "left").join(in_csv, "id", "left").join(in_json, "detail_link", "left").select(
        "id", "detail_link", "rank", F.array_join("flags", ",").alias("flags"), F.coalesce("comments", F.lit(0)).alias("comments"),
        F.coalesce("csv_comments", F.lit(0)).alias("csv_comments"), "json_items",
    )


@query(
    """
WITH e AS (SELECT CASE WHEN event_id % 11 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id, event_id, event_type, value, ts FROM events)
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM e)
WHERE rn = 1 OR user_id IS NULL
"""
)
def upsert_partitions(spark, sf):
    """The events of three stretches of days put one after the other into a table that replaces only the parts they touch."""
    root = scratch_dir(spark, "upsert_partitions")
    user = F.when(F.col("event_id") % 11 != 0, F.col("user_id").cast("string")).alias("user_id")
    rows = table(spark, sf, "events").select(user, "event_id", "event_type", "value", "ts")
    for number in range(3):
        sinks.upsert_table(rows.where(_days(rows, 10) == number), f"{root}/table", ["user_id"], ["ts", "event_id"], parts=8)
    return sinks.read_upserted_table(spark, f"{root}/table").drop("ts")


GATHER_CAP = 200


@query(
    PAGES_SQL.replace("l_partkey", "l_suppkey").replace("before < 15", f"before < {GATHER_CAP}")
    + f"""
SELECT l_suppkey, l_linenumber, l_orderkey, l_partkey, l_extendedprice FROM (
  SELECT l.*, row_number() OVER (PARTITION BY l_suppkey
    ORDER BY l_linenumber, l_orderkey, l_partkey, l_shipdate, l_extendedprice) AS rn
  FROM lineitem l JOIN opened USING (l_suppkey, l_linenumber)) WHERE rn <= {GATHER_CAP}
"""
)
def stream_gather(spark, sf):
    """Pages of each supplier's lines, one batch a page number, held in state until a supplier is complete; stopped and started again for each."""
    root = scratch_dir(spark, "gather")
    order = ["l_orderkey", "l_partkey", "l_shipdate", "l_extendedprice"]
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_linenumber", *order).where("l_suppkey is not null")
    lines = lines.withColumn("read_at", F.timestamp_seconds(F.lit(1_577_836_800) + F.col("l_linenumber") * 86_400))

    def run():
        gathered = state.gather_pages(
            _arrived(lines, f"{root}/in"), ["l_suppkey"], "l_linenumber", order, "read_at", idle_hours=36, cap=GATHER_CAP
        )
        flows.to_files(gathered, f"{root}/out", f"{root}/checkpoint", state.GATHER_SETTINGS).awaitTermination()

    # later pages only tell how far the reading is; every run goes on from the state of the one before
    _deliver(lines, f"{root}/in", F.col("l_linenumber"), range(1, 8), run)
    return spark.read.parquet(f"{root}/out").drop("l_shipdate", "read_at")


@query(
    """
WITH RECURSIVE e AS (
  SELECT user_id, event_type, event_id, ts, CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 3) AS INTEGER) AS batch FROM events),
marks AS (SELECT batch + 2 AS batch, max(ts) - INTERVAL 2 DAY AS mark FROM e GROUP BY batch),
r AS (SELECT e.*, m.mark FROM e LEFT JOIN marks m ON m.batch = e.batch),
kept AS (
  SELECT user_id, event_type, min(event_id) AS event_id, arg_min(ts, event_id) AS ts FROM r GROUP BY user_id, event_type
  UNION ALL
  SELECT r.user_id, r.event_type, min(r.event_id), arg_min(r.ts, r.event_id)
  FROM kept k JOIN r ON r.user_id = k.user_id AND r.event_type = k.event_type AND r.mark >= k.ts + INTERVAL 2 DAY
  GROUP BY r.user_id, r.event_type)
SELECT user_id, event_type, event_id FROM kept
"""
)
def stream_dedup_bounded(spark, sf):
    """Events three days a batch, a key's first row until it is forgotten; the first days come once more at the end, and are late.

    A key returns once a watermark two days past its row was reached before the batch before: what the SQL spells out.
    """
    root = scratch_dir(spark, "dedup_bounded")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    late = events.where(_days(events, 3) == 0).withColumn("event_id", -1 - F.col("event_id"))
    rows = events.withColumn("batch", _days(events, 3)).unionByName(late.withColumn("batch", F.lit(10).cast("long")))
    keys = ["user_id", "event_type"]

    def write(batch, path):
        # a key's rows stand together in one file, its first one first
        batch.repartition(*keys).sortWithinPartitions(*keys, "ts", "event_id").write.parquet(path)

    def run():
        unique = state.dedup_bounded(_arrived(rows, f"{root}/in"), keys, "ts", "2 days")
        flows.to_files(unique, f"{root}/out", f"{root}/checkpoint", state.ROWS_ONLY).awaitTermination()

    _deliver(rows, f"{root}/in", F.col("batch"), range(11), run, write)
    return spark.read.parquet(f"{root}/out").select("user_id", "event_type", "event_id")
