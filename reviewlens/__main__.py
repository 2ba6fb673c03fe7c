"""Programs over movie files, item files and run reports.

    python -m reviewlens pages --lists lists/ --details details/ --out folder
    python -m reviewlens movies --movies raw.json --reviews reviews.json --out folder
    python -m reviewlens items --source folder-of-json-lines --out folder
    python -m reviewlens compare --runs runs.json --baseline a --candidate b --out folder
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas as S
from .operators import relate, validate
from .operators.compare import run_comparison
from .operators.extract import refused_pages
from .plans import catalogue, items
from .session import build_session
from .sources import files, sinks


def _store(df: DataFrame, schema: T.StructType, absent: dict[str, object], path: str) -> None:
    """Write a numbered table in its stored form."""
    stored = T.StructType([T.StructField("id", T.LongType()), *schema.fields])
    sinks.with_load_time(sinks.conform(df, stored, absent)).write.mode("overwrite").parquet(path)


def _pages(spark: SparkSession, opts: argparse.Namespace) -> int:
    posters = files.list_assets(spark, opts.posters) if opts.posters else None
    lists, details = spark.read.parquet(opts.lists), spark.read.parquet(opts.details)
    good, blocked = validate.split_blocked(lists, opts.block_host, S.BLOCK_PHRASES)
    movies, reviews = catalogue.assemble(good, details, posters, opts.posters or "")
    blocked.select("page_id", "url").write.mode("overwrite").parquet(f"{opts.out}/blocked")
    refused = refused_pages(good.select("url", "html").unionByName(details.select("url", "html")), keep=("url",))
    refused.write.mode("overwrite").parquet(f"{opts.out}/refused")
    sinks.write_json(movies, f"{opts.out}/movies.json")
    sinks.write_json(reviews, f"{opts.out}/reviews.json")
    return 0


def _movies(spark: SparkSession, opts: argparse.Namespace) -> int:
    raw = files.load_raw(spark, opts.movies, S.RAW_MOVIES, opts.lines)
    movies = catalogue.clean_movies(raw).persist()
    if movies.isEmpty():
        print("no movie is left after cleaning")
        return 1
    try:
        sinks.check_unique(movies, ["rank_num"])
        sinks.check_constraints(movies, S.MOVIE_LIMITS, S.MOVIE_NOT_NULL)
    except sinks.ConstraintError as refusal:
        print(f"movies are not loaded, the old table stays: {refusal}")
        return 1
    numbered = relate.with_row_id(movies, ["rank_num", "title", "rating"])
    sinks.fan_out(
        numbered,
        [
            lambda df: sinks.write_csv(df.drop("id"), f"{opts.out}/movies_csv", bom=True),
            lambda df: sinks.write_json(df.drop("id"), f"{opts.out}/movies_json"),
            lambda df: _store(df, S.MOVIES_TABLE, S.MOVIES_ABSENT, f"{opts.out}/movies"),
        ],
    )
    reports = {
        "nulls_before": validate.null_report(raw),
        "nulls_after": validate.null_report(movies),
        "constraints": validate.constraint_report(movies, S.MOVIE_LIMITS, S.MOVIE_NOT_NULL),
        "duplicate_ranks": relate.unique_violations(movies, ["rank_num"]),
        "rank_id_mismatch": relate.surrogate_mismatch(numbered, "rank_num"),
        **catalogue.movie_reports(movies),
    }
    if opts.reviews:
        reviews = relate.number_rows(files.load_raw(spark, opts.reviews, S.REVIEWS, opts.lines), "__number")
        reviews = reviews.withColumn("ordinal", F.coalesce("ordinal", "__number")).drop("__number")
        unique = relate.dedup_reviews(reviews, "movie_rank", "username", "content", ["ordinal"])
        stored = sinks.comments_for_load(unique, movies)
        try:
            sinks.check_constraints(stored, S.COMMENT_LIMITS, S.COMMENT_NOT_NULL)
        except sinks.ConstraintError as refusal:
            print(f"reviews are not loaded, the old table stays: {refusal}")
            return 1
        stored = relate.with_row_id(stored, ["ordinal"])
        _store(stored, S.COMMENTS_TABLE, S.COMMENTS_ABSENT, f"{opts.out}/comments")
        parents = movies.select(F.col("rank_num").alias("movie_rank"))
        reports["orphan_reviews"] = relate.fk_rejects(unique, parents, ["movie_rank"])
        labelled = spark.read.parquet(opts.labelled) if opts.labelled else None
        reports.update(catalogue.review_reports(reviews, labelled))
    for name, report in reports.items():
        report.write.mode("overwrite").parquet(f"{opts.out}/reports/{name}")
    return 0


def _items(spark: SparkSession, opts: argparse.Namespace) -> int:
    items.store_items(items.item_stream(spark, opts.source), opts.out).awaitTermination()
    movies, comments = items.read_items(spark, opts.out)
    movies.write.mode("overwrite").parquet(f"{opts.out}/movies")
    comments.write.mode("overwrite").parquet(f"{opts.out}/comments")
    return 0


def _compare(spark: SparkSession, opts: argparse.Namespace) -> int:
    runs = files.read_json(spark, opts.runs, S.RUNS)
    report = run_comparison(runs, opts.baseline, opts.candidate, opts.limit)
    sinks.write_json(report, f"{opts.out}/comparison")
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="reviewlens", description=__doc__)
    programs = parser.add_subparsers(dest="program", required=True)
    args = programs.add_parser("pages", help="parse list and detail pages into raw movies and reviews")
    args.add_argument("--lists", required=True, help="Parquet table (page_id, url, html) of list pages")
    args.add_argument("--details", required=True, help="Parquet table (url, html), url being a movie's link")
    args.add_argument("--posters", help="folder of poster files")
    args.add_argument("--block-host", action="append", default=[], help="host that marks a blocked page")
    args.set_defaults(run=_pages)
    args = programs.add_parser("movies", help="clean movies, relate reviews, write tables and reports")
    args.add_argument("--movies", required=True, help="raw movies, .json or .csv")
    args.add_argument("--reviews", help="reviews, .json or .csv")
    args.add_argument("--labelled", help="Parquet table (text, label) to learn sentiment from")
    args.add_argument("--lines", action="store_true", help="JSON files hold one record per line")
    args.set_defaults(run=_movies)
    args = programs.add_parser("items", help="store new item files by link and export them")
    args.add_argument("--source", required=True, help="folder of JSON Lines files")
    args.set_defaults(run=_items)
    args = programs.add_parser("compare", help="compare two collection runs")
    args.add_argument("--runs", required=True, help="JSON Lines file of runs")
    args.add_argument("--baseline", required=True)
    args.add_argument("--candidate", required=True)
    args.add_argument("--limit", type=int, default=10, help="records each run was to collect")
    args.set_defaults(run=_compare)
    for sub in programs.choices.values():
        sub.add_argument("--out", required=True)
    opts = parser.parse_args(argv)
    return opts.run(build_session(), opts)


if __name__ == "__main__":
    raise SystemExit(main())
