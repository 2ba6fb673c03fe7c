"""The movie corpus from pages to tables and reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import markup, names, numbers, texts
from ..functions import patterns as P
from ..operators import clean, relate, sentiment, stats, words
from ..operators.extract import explode_blocks, pick, step

# Where the fields of the list, detail and review pages stand.
LIST_ITEM = step("div.item")
MOVIE_FIELDS = {
    "rank": pick("em"),
    "main": pick("span.title"),
    "other": pick("span.other"),
    "score": pick("span.rating_num"),
    "spans": pick("span", every=True),
    "about": pick("div.bd", "p"),
    "quote_text": pick("p.quote"),
    "quote_span": pick("p.quote", "span"),
    "link": pick("a", attr="href", only_first=True),
    "image": pick("img", attr="src"),
}
ITEM_FIELDS = {
    "rank": pick("div.pic", "em", own_text=True),
    "titles": pick("div.hd", "span.title", own_text=True, every=True),
    "rating": pick("span.rating_num", own_text=True),
    "stars": pick("div.star", "span", own_text=True, every=True),
    "about": pick("div.bd", "p", own_text=True, every=True),
    "quote": pick("span.inq", own_text=True),
    "detail_link": pick("div.hd", "a", attr="href"),
}
DETAIL_INFO = step("div", id="info")
DETAIL_PAGE = step("body")
REVIEW_BLOCK = step("div.comment-item")
REVIEW_FIELDS = {
    "username": pick("span.comment-info", "a"),
    "rating": pick("span.rating", attr="title"),
    "content": pick("span.short"),
    "comment_time": pick("span.comment-time"),
}
VOTES_MARK = "人评价"
QUOTE_MARKS = "“”\""


def _or_empty(col: str):
    return F.coalesce(F.col(col), F.lit(""))


def parse_movies(pages: DataFrame, keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """Movies of list pages with ``reject_reason``; NULL there for those that pass the gate."""
    blocks = explode_blocks(pages, LIST_ITEM, MOVIE_FIELDS, keep)
    quote = texts.first_non_empty(
        F.col("quote_span"),
        F.btrim(_or_empty("quote_text"), F.lit(QUOTE_MARKS)),
        default=S.MOVIE_DEFAULTS["quote"],
    )
    title = texts.full_title(F.col("main"), F.col("other"))
    parsed = blocks.select(
        *keep,
        "position",
        numbers.digits_or_zero(_or_empty("rank")).alias("rank_num"),
        title.alias("title"),
        numbers.decimal_or_zero(_or_empty("score")).alias("rating"),
        markup.marked_number(F.col("spans"), VOTES_MARK).alias("comment_num"),
        F.replace(_or_empty("about"), F.lit("  "), F.lit(" ")).alias("info"),
        quote.alias("quote"),
        texts.strip(_or_empty("link")).alias("detail_url"),
        texts.strip(_or_empty("image")).alias("poster_url"),
        F.concat(names.safe_name(title), F.lit(names.DEFAULT_EXTENSION)).alias("poster_name"),
    )
    return clean.movie_gate(parsed)


def parse_details(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(keep, detail_url, year, runtime, imdb) of detail pages, '' for what is not found."""
    info = explode_blocks(pages, DETAIL_INFO, {"info": pick()}, keep=("url", *keep)).where(F.col("position") == 1)
    text = F.col("info")
    minutes = F.regexp_extract(text, P.RUNTIME, 1)
    return info.select(
        *keep,
        F.col("url").alias("detail_url"),
        texts.first_match(text, P.YEAR).alias("year"),
        F.when(minutes != "", F.concat(minutes, F.lit("分钟"))).otherwise(F.lit("")).alias("runtime"),
        texts.first_match(text, P.IMDB).alias("imdb"),
    )


def parse_items(pages: DataFrame, keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """Items of list pages in the nested flow: all fields texts, items without a link dropped."""
    blocks = explode_blocks(pages, LIST_ITEM, ITEM_FIELDS, keep)
    return blocks.select(
        *keep,
        "position",
        _or_empty("rank").alias("rank"),
        F.get("titles", F.lit(0)).alias("title_cn"),
        F.get("titles", F.lit(1)).alias("title_en"),
        _or_empty("rating").alias("rating"),
        F.get("stars", F.size("stars") - 1).alias("rating_count"),
        F.when(F.size("about") > 0, markup.join_texts(F.col("about"), " ")).alias("directors_cast"),
        _or_empty("quote").alias("quote"),
        _or_empty("detail_link").alias("detail_link"),
    ).where(F.col("detail_link") != "")


def parse_item_details(pages: DataFrame) -> DataFrame:
    """(detail_link, year, duration, genre, imdb_rating, poster_url); NULL for what is not found but genre ''."""
    fields = {
        "year_text": pick("span.year", own_text=True),
        "info": pick_having("div", own_text=True, every=True, id="info"),
        "genres": pick_having("span", own_text=True, every=True, property="v:genre"),
        "imdb": pick("a", where=("href", "imdb.com")),
        "posters": pick_having("div", "img", attr="src", id="mainpic"),
    }
    body = explode_blocks(pages, DETAIL_PAGE, fields, keep=("url",)).where(F.col("position") == 1)
    info = markup.join_texts(F.col("info"), " ")
    return body.select(
        F.col("url").alias("detail_link"),
        F.btrim("year_text", F.lit("() ")).alias("year"),
        F.nullif(F.regexp_extract(info, P.DURATION, 1), F.lit("")).alias("duration"),
        markup.join_texts(F.col("genres"), ", ").alias("genre"),
        F.col("imdb").alias("imdb_rating"),
        F.col("posters").alias("poster_url"),
    )


def pick_having(*path: str, **options):
    """As ``pick``; attributes other than pick's own are required of the first step."""
    own = {k: options.pop(k) for k in ("attr", "own_text", "every") if k in options}
    first, *rest = path
    made = pick(*rest, **own)
    return type(made)((step(first, **options), *made.path), made.attr, made.own_text, made.every)


def parse_reviews(
    pages: DataFrame,
    keep: Sequence[str] = ("page_id", "url"),
    no_rating: str = S.NO_RATING_FLAT,
    limit: int | None = None,
    require: Sequence[str] = (),
) -> DataFrame:
    """Reviews with text, in page order; with ``limit`` those among the first ``limit`` blocks of a page.

    A block that lacks one of the elements ``require`` names (username, comment_time) is skipped.
    """
    blocks = explode_blocks(pages, REVIEW_BLOCK, REVIEW_FIELDS, keep)
    if limit is not None:
        blocks = blocks.where(F.col("position") <= limit)
    blocks = blocks.dropna(subset=list(require)) if require else blocks
    return blocks.select(
        *keep,
        "position",
        _or_empty("username").alias("username"),
        F.coalesce("rating", F.lit(no_rating)).alias("rating"),
        _or_empty("content").alias("content"),
        _or_empty("comment_time").alias("comment_time"),
    ).where(F.length("content") > 0)


def with_poster_paths(movies: DataFrame, listing: DataFrame, folder: str, min_bytes: int = 1024) -> DataFrame:
    """Adds ``poster_path``: the file of a movie's poster where ``listing`` has a valid one, else ''."""
    held = listing.where(F.col("length") > min_bytes).select(F.col("name").alias("poster_name")).distinct()
    valid = held.withColumn("__held", F.lit(True))
    path = F.concat(F.lit(folder.rstrip("/") + "/"), "poster_name")
    return (
        movies.join(valid, "poster_name", "left")
        .withColumn("poster_path", F.when(F.col("__held"), path).otherwise(F.lit("")))
        .drop("__held")
    )


def _of_latest(details: DataFrame, order_by: Sequence, parse: Callable[[DataFrame], DataFrame], url: str, rows: Sequence[str]) -> DataFrame:
    """What ``parse`` finds on one page per url, the last in ``order_by`` and then by a digest; pages without url belong to no movie.

    All pages are parsed where they lie, with their digest; only urls and digests, and the narrow parsed rows, are shuffled. ``rows``
    tell the rows of one page apart, so that a page stored twice counts once.
    """
    named = details.where(F.col("url") != "").withColumn("__page", F.xxhash64("html"))
    order = [(F.col(c) if isinstance(c, str) else c).alias(f"__order{i}") for i, c in enumerate(order_by)]
    marks = named.select("url", "__page", *order)
    last = relate.keep_last(marks, ["url"], [*(f"__order{i}" for i in range(len(order))), "__page"])
    found = parse(named).join(last.select(F.col("url").alias(url), "__page"), [url, "__page"], "left_semi")
    return found.dropDuplicates([url, *rows]).drop("__page")


def assemble_movies(
    lists: DataFrame, details: DataFrame, posters: DataFrame | None = None, folder: str = "",
    order_by: Sequence = (),
) -> DataFrame:
    """Raw movies from list pages (page_id, url, html) and detail pages (url, html).

    Movies pass the gate. One with a link gets year, runtime and imdb from its detail page, '' where that
    has none; one without a link gets NULL and meets no detail page. Of several pages of one url the last in
    ``order_by`` (columns of ``details``) counts.
    """
    passed = clean.accepted(parse_movies(lists))
    linked = F.col("detail_url") != ""
    extra = ["year", "runtime", "imdb"]
    pages = _of_latest(details, order_by, lambda df: parse_details(df, ("__page",)), "detail_url", [])
    found = relate.override(passed.where(linked), pages, "detail_url", extra)
    without = passed.where(~linked).withColumns({c: F.lit(None).cast("string") for c in extra})
    movies = found.unionByName(without)
    if posters is not None:
        movies = with_poster_paths(movies, posters, folder)
    else:
        movies = movies.withColumn("poster_path", F.lit(""))
    return movies.select(*[F.col(c).cast("string").alias(c) for c in S.RAW_MOVIES.names])


def assemble_reviews(lists: DataFrame, details: DataFrame, order_by: Sequence = ()) -> DataFrame:
    """Reviews of the listed movies with gap-free ordinals, from list pages and detail pages.

    They are taken before the gate, so those of a rejected movie stay, as orphans. Blocks without author or time
    are skipped.
    """
    listed = parse_movies(lists).where(F.col("detail_url") != "").select("page_id", "position", "rank_num", "detail_url")
    def parse(df: DataFrame) -> DataFrame:
        return parse_reviews(df, ("url", "__page"), limit=S.REVIEWS_PER_MOVIE, require=("username", "comment_time"))

    found = _of_latest(details, order_by, parse, "url", ["position"]).withColumnsRenamed({"url": "detail_url", "position": "review"})
    numbered = relate.with_row_id(
        found.join(listed, "detail_url").select(
            "page_id", "position", "review", F.col("rank_num").cast("int").alias("movie_rank"),
            "username", "rating", "content", "comment_time",
        ),
        ["page_id", "position", "review"],
        "ordinal",
    )
    return numbered.select(*S.REVIEWS.names)


def assemble(lists: DataFrame, details: DataFrame, posters: DataFrame | None = None, folder: str = "",
             order_by: Sequence = ()) -> tuple[DataFrame, DataFrame]:
    """(raw movies, reviews); each is parsed only when it is used."""
    return assemble_movies(lists, details, posters, folder, order_by), assemble_reviews(lists, details, order_by)


def clean_movies(raw: DataFrame, order_by: Sequence[str] = ("rank_num",)) -> DataFrame:
    """Drop, fill, cast, extract, dedup, range - in this order, on which the result depends.

    A bad rating becomes 0.0 and stays; fields read from ``info`` replace those the record had.
    Of rows with one title and rating the first in ``order_by`` stays.
    """
    d = S.MOVIE_DEFAULTS
    kept = clean.fill_defaults(clean.drop_missing(raw, S.REQUIRED_MOVIE), d)
    typed = kept.withColumns(
        {
            "rank_num": numbers.safe_long(F.col("rank_num")),
            "rating": numbers.safe_double(F.col("rating"), 0.0, digits=1),
            "comment_num": numbers.safe_long(F.col("comment_num"), separators=","),
        }
    )
    info = F.col("info")
    full = typed.withColumns(
        {
            "director": texts.director(info, d["director"]),
            "year": texts.year(info, d["year"]),
            "genre": texts.genre(info, d["genre"]),
            "actors": texts.actors(info, d["actors"]),
        }
    )
    return clean.in_range(relate.keep_first(full, ["title", "rating"], list(order_by)), "rating", 0, 10)


def movie_reports(movies: DataFrame) -> dict[str, DataFrame]:
    """Reports over cleaned movies."""
    d = S.MOVIE_DEFAULTS
    return {
        "top_movies": stats.top_k(
            movies, "rating", 10, ["rank_num", "title", "rating", "comment_num", "director"], ["rank_num", "title"]
        ),
        "directors": stats.value_counts(movies, "director", 15),
        "genres": stats.explode_counts(movies, "genre", " ", exclude=[d["genre"]]),
        "genre_shares": stats.shares(movies, "genre", "|", 10),
        "years": stats.year_counts(movies, "year", exclude=[d["year"]]),
        "decades": stats.decade_counts(movies, F.col("year")),
        "rating_summary": stats.numeric_summary(movies, "rating"),
        "rating_histogram": stats.histogram(movies, "rating"),
        "rating_density": stats.kde(movies, "rating"),
        "rating_votes_correlation": stats.correlation(movies, "rating", "comment_num"),
        "rating_votes_trend": stats.trend(movies, "rating", "comment_num"),
        "rating_votes_band": stats.trend_bootstrap(
            movies, "rating", "comment_num", F.concat_ws("|", "title", F.col("rating").cast("string"))
        ),
    }


def review_reports(
    reviews: DataFrame, labelled: DataFrame | None = None, content: str = "content", id_col: str = "ordinal",
    cloud_stop: Sequence[str] = (), splitter: words.Splitter = words.split_pairs,
) -> dict[str, DataFrame]:
    """Reports over reviews; sentiment only with ``labelled`` (text, label 0/1) to learn from."""
    held = reviews.where(F.length(content) > 0)
    out = {
        "keywords": words.keywords(held, content, 20, stop=S.KEYWORD_STOP_WORDS, splitter=splitter),
        "cloud_terms": words.cloud_terms(
            held, content, 300, keep=P.KEEP_CJK, stop=cloud_stop, splitter=splitter
        ),
    }
    if labelled is not None:
        model = sentiment.fit_nb(labelled, "text", "label", splitter=splitter)
        scored = sentiment.with_sentiment(sentiment.score(held, model, id_col, content, splitter=splitter))
        out["sentiment"] = scored
        out["sentiment_summary"] = sentiment.summary(scored)
        out["sentiment_average"] = sentiment.average(scored)
    return out
