"""The nested item flow: a stream of items into a keyed table and its exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..operators import relate
from ..sources import sinks
from ..streaming import flows

KEY, ORDER, COMMENTS = "detail_link", "crawled_at", "hot_comments"


def item_stream(spark: SparkSession, folder: str, max_files: int = flows.MAX_FILES) -> DataFrame:
    """Items from JSON Lines files as they arrive."""
    return flows.file_stream(spark, folder, S.ITEMS, "json", max_files)


def store_items(stream: DataFrame, out: str) -> StreamingQuery:
    """Validate, upsert by link, export to JSON, then to one CSV of movies and one of their reviews.

    Validation only flags. An item that comes again replaces the row it had, its reviews with it. A link is numbered when it first
    arrives and keeps its number; the exported reviews carry it as ``movie_id``.
    """
    flagged = flows.validate_stream(stream, S.REQUIRED_ITEM, "rating")

    def numbered(df: DataFrame, batch_id: int) -> DataFrame:
        return flows.number_keys(df, batch_id, f"{out}/ids", KEY, "id")

    def to_json(batch_id: int) -> sinks.Writer:
        return lambda df: sinks.write_json(df.drop("flags", "id"), f"{out}/json/{flows.BATCH}={batch_id}")

    def to_csv(batch_id: int) -> sinks.Writer:
        def write(df: DataFrame) -> None:
            movies, comments = relate.split_nested(df.drop("flags"), COMMENTS, "id")
            movies = movies.drop("id")
            sinks.write_csv(movies.select(*sorted(movies.columns)), f"{out}/movies_csv/{flows.BATCH}={batch_id}")
            sinks.write_csv(comments.withColumnRenamed("id", "movie_id"), f"{out}/comments_csv/{flows.BATCH}={batch_id}")

        return write

    return flows.upsert_stream(flagged, f"{out}/items", [KEY], [ORDER], f"{out}/checkpoint", [to_json, to_csv], numbered)


def read_items(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """(movies with their flags, reviews with the link and the id of their movie)."""
    items = flows.read_upserted(spark, f"{out}/items", [KEY], [ORDER])
    movies, comments = relate.split_nested(items, COMMENTS, "id")
    return movies, comments.withColumnRenamed("id", "movie_id")


def read_exports(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """(items of the JSON export, reviews of the CSV export) of the committed batches, with their batch_id."""
    items = flows.read_committed(spark, f"{out}/items", f"{out}/json", "json", S.ITEMS)
    comments = flows.read_committed(spark, f"{out}/items", f"{out}/comments_csv", "csv", header=True, escape='"', multiLine=True)
    return items, comments.withColumn("movie_id", F.col("movie_id").cast("long"))


def items_from_pages(lists: DataFrame, details: DataFrame, reviews: DataFrame, spider: str = "reviewlens") -> DataFrame:
    """Items from parsed list pages, detail pages and review pages.

    ``reviews`` has detail_link, page, position and the review fields; a movie takes its first 15
    from at most 3 pages, so the array built for it is as short.
    """
    kept = relate.accumulate_pages(
        reviews.where(F.length("content") > 0), [KEY], "page", ["position"], S.REVIEWS_PER_MOVIE, S.MAX_REVIEW_PAGES
    )
    entry = F.struct(
        "page", "position", F.col("username").alias("author"), F.col("rating").alias("score"),
        F.col("comment_time").alias("time"), "content",
    )
    nested = kept.groupBy(KEY).agg(
        F.transform(
            F.array_sort(F.collect_list(entry)), lambda c: F.struct(c.author, c.score, c.time, c.content)
        ).alias(COMMENTS)
    )
    return (
        lists.join(details, KEY, "left")
        .join(nested, KEY, "left")
        .withColumn("crawled_at", sinks.iso_now())
        .withColumn("spider_name", F.lit(spider))
    )
