"""Validation, filters, defaults, casts and field extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import names, numbers
from ..functions import patterns as P
from ..functions import texts as X
from ..operators import clean, validate
from ..plans.catalogue import clean_movies
from ..session import spread
from .base import SQL_MOVIES, WORD, movies, query, sql_clean, sql_collapse, sql_number, sql_strip, table

D = S.MOVIE_DEFAULTS


def _labelled(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")


LABELLED = "(SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"
LABELLED_COLS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, count(*) AS total_rows FROM {LABELLED}"
        for c in LABELLED_COLS
    )
)
def null_report(spark, sf):
    return validate.null_report(_labelled(spark, sf))


RATING_TEXT = sql_strip("rating")


@query(
    f"""
SELECT ordinal, rating, array_to_string(list_filter([
  CASE WHEN coalesce(rank_num, '') = '' THEN 'missing:rank_num' END,
  CASE WHEN coalesce(title, '') = '' THEN 'missing:title' END,
  CASE WHEN coalesce(rating, '') = '' THEN 'missing:rating' END,
  CASE WHEN coalesce(runtime, '') = '' THEN 'missing:runtime' END,
  CASE WHEN coalesce(rating, '') = '' THEN NULL
       WHEN lower({RATING_TEXT}) IN ('nan', 'inf', 'infinity') THEN 'range:rating'
       WHEN {sql_number("rating")} IS NULL THEN 'format:rating'
       WHEN {sql_number("rating")} < 0 OR {sql_number("rating")} > 10 THEN 'range:rating' END
], lambda x: x IS NOT NULL), ',') AS flags
FROM ({SQL_MOVIES})
"""
)
def validation_flags(spark, sf):
    checked = validate.validate(movies(spark, sf), ["rank_num", "title", "rating", "runtime"], "rating")
    return checked.select("ordinal", "rating", F.array_join("flags", ",").alias("flags"))


LIMITS = {"c_name": 17, "c_mktsegment": 8}


@query(
    " UNION ALL ".join(
        [
            f"SELECT '{c}' AS column_name, 'max_length:{n}' AS rule, count(*) FILTER (length({c}) > {n}) AS violations "
            "FROM customer"
            for c, n in LIMITS.items()
        ]
        + ["SELECT 'c_acctbal', 'not_null', count(*) FILTER (c_acctbal IS NULL) FROM customer"]
    )
)
def constraint_report(spark, sf):
    return validate.constraint_report(table(spark, sf, "customer"), LIMITS, ["c_acctbal"])


@query(f"SELECT doc_id, lang, quality, toxic FROM {LABELLED} WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def drop_missing(spark, sf):
    return clean.drop_missing(_labelled(spark, sf), ["quality", "toxic"]).select("doc_id", "lang", "quality", "toxic")


@query("SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice >= 905 AND p_retailprice <= 960")
def range_filter(spark, sf):
    return clean.in_range(table(spark, sf, "part").select("p_partkey", "p_retailprice"), "p_retailprice", 905, 960)


RANK_SQL = "(CASE WHEN regexp_matches(coalesce(rank_num, ''), '^[0-9]+$') THEN CAST(rank_num AS BIGINT) ELSE 0 END)"
SCORE_SQL = (
    "(CASE WHEN regexp_matches(replace(coalesce(rating, ''), '.', ''), '^[0-9]+$') "
    "THEN TRY_CAST(rating AS DOUBLE) ELSE 0.0 END)"
)


@query(
    f"""
SELECT ordinal, {RANK_SQL} AS rank_num, {SCORE_SQL} AS rating,
  CASE WHEN coalesce(title, '') = '' THEN 'title' WHEN {RANK_SQL} = 0 THEN 'rank_num'
       WHEN coalesce({SCORE_SQL}, 0) = 0 THEN 'rating' END AS reject_reason
FROM ({SQL_MOVIES})
"""
)
def quality_gate(spark, sf):
    parsed = movies(spark, sf).select(
        "ordinal",
        "title",
        numbers.digits_or_zero(F.coalesce("rank_num", F.lit(""))).alias("rank_num"),
        numbers.decimal_or_zero(F.coalesce("rating", F.lit(""))).alias("rating"),
    )
    return clean.movie_gate(parsed).drop("title")


@query("SELECT event_id, event_type, value FROM events WHERE event_type IN ('error', 'purchase')")
def isin_filter(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    return events.where(F.col("event_type").isin("error", "purchase"))


@query(
    """
SELECT page_id, url, contains(url, 'spam-farm.example.org') OR contains(html, 'spam-farm.example.org')
  OR contains(html, 'lang="de"') AS blocked FROM pages
"""
)
def blocked_pages(spark, sf):
    marked = validate.blocked(F.col("url"), F.col("html"), ["spam-farm.example.org"], ['lang="de"'])
    return table(spark, sf, "pages").select("page_id", "url", marked.alias("blocked"))


@query(
    f"""
SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic, text FROM {LABELLED}
"""
)
def fill_defaults(spark, sf):
    filled = clean.fill_defaults(_labelled(spark, sf), {"quality": -1, "toxic": 0, "no_such_column": 1})
    return filled.select("doc_id", "quality", "toxic", "text")


@query(
    f"""
SELECT ordinal,
  CAST(trunc(coalesce({sql_number("rank_num")}, 0)) AS BIGINT) AS rank_num,
  round_even(coalesce({sql_number("rating")}, 0.0) * 10, 0) / 10 AS rating,
  CAST(trunc(coalesce({sql_number("replace(comment_num, ',', '')")}, 0)) AS BIGINT) AS comment_num
FROM ({SQL_MOVIES})
"""
)
def safe_cast(spark, sf):
    return movies(spark, sf).select(
        "ordinal",
        numbers.safe_long(F.col("rank_num")).alias("rank_num"),
        numbers.safe_double(F.col("rating"), 0.0, 1).alias("rating"),
        numbers.safe_long(F.col("comment_num"), separators=",").alias("comment_num"),
    )


@query(
    """
SELECT event_id, coalesce(TRY_CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT), 0) AS k,
  round_even(value * 10, 0) / 10 AS value FROM events
"""
)
def guarded_number(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        numbers.digits_or_zero(F.regexp_extract("props", '"k": ([0-9]+)', 1)).alias("k"),
        numbers.half_even(F.col("value"), 1).alias("value"),
    )


_UNSAFE = names.UNSAFE_CHARS.replace("'", "''")


@query(
    f"""
SELECT page_id,
  {sql_strip(f"left(translate(url, '{_UNSAFE}', '{'_' * len(names.UNSAFE_CHARS)}'), 30)")} AS short_name,
  left(regexp_replace(coalesce(nullif(url, ''), concat('movie_', page_id)), '[\\\\/:*?"<>|]+', '_', 'g'), 100)
    AS long_name
FROM pages
"""
)
def safe_name(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        names.safe_name(F.col("url")).alias("short_name"),
        names.safe_title(F.col("url"), F.lit(""), F.col("page_id")).alias("long_name"),
    )


@query(f"SELECT doc_id, {sql_clean('text', P.KEEP_LATIN)} AS cleaned FROM documents")
def clean_text_delete(spark, sf):
    return spread(table(spark, sf, "documents").select("doc_id", "text")).select(
        "doc_id", X.clean_delete(F.col("text"), P.KEEP_LATIN).alias("cleaned")
    )


LETTERS = r"\p{L}"


@query(
    f"""SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '[^{LETTERS}]+', ' ', 'g'), ' ') AS cleaned
FROM documents"""
)
def clean_text_space(spark, sf):
    return spread(table(spark, sf, "documents").select("doc_id", "text")).select(
        "doc_id", X.clean_space(F.col("text"), LETTERS).alias("cleaned")
    )


# Field extraction from the two-line info text.
INFO = f"(SELECT ordinal, coalesce(info, '{D['info']}') AS info FROM ({SQL_MOVIES}))"
LINE1 = "split_part(info, chr(10), 1)"
LINE2 = "(CASE WHEN contains(info, chr(10)) THEN split_part(info, chr(10), 2) ELSE info END)"
DIRECTOR_PART = (
    f"(CASE WHEN contains({LINE1}, '导演:') THEN "
    + sql_strip(f"split_part(split_part({LINE1}, '导演:', 2), '主演:', 1)")
    + " END)"
)
ACTOR_PART = f"(CASE WHEN contains({LINE1}, '主演:') THEN " + sql_strip(f"split_part({LINE1}, '主演:', 2)") + " END)"
DIRECTOR = (
    f"coalesce(nullif(regexp_extract({DIRECTOR_PART}, '({P.CJK_NAME})', 1), ''), "
    f"nullif(regexp_extract({DIRECTOR_PART}, '({WORD})', 1), ''), '{D['director']}')"
)
ACTORS = (
    f"coalesce(nullif(array_to_string((regexp_extract_all({ACTOR_PART}, '{P.CJK_NAME}'))[1:3], '、'), ''), "
    f"nullif(left({ACTOR_PART}, 50), ''), '{D['actors']}')"
)
YEAR = f"coalesce(nullif(regexp_extract({LINE2}, '{P.YEAR}', 1), ''), '{D['year']}')"
GENRE = (
    f"CASE WHEN contains({LINE2}, '/') THEN coalesce(nullif("
    + sql_collapse(f"split_part({LINE2}, '/', -1)")
    + f", ''), '{D['genre']}') ELSE '{D['genre']}' END"
)


def _info(spark, sf):
    return movies(spark, sf).select("ordinal", F.coalesce("info", F.lit(D["info"])).alias("info"))


@query(f"SELECT ordinal, {DIRECTOR} AS director FROM {INFO}")
def segment_extract(spark, sf):
    return _info(spark, sf).select("ordinal", X.director(F.col("info"), D["director"]).alias("director"))


@query(f"SELECT ordinal, {YEAR} AS year FROM {INFO}")
def first_match(spark, sf):
    return _info(spark, sf).select("ordinal", X.year(F.col("info"), D["year"]).alias("year"))


@query(f"SELECT ordinal, {GENRE} AS genre FROM {INFO}")
def last_segment(spark, sf):
    return _info(spark, sf).select("ordinal", X.genre(F.col("info"), D["genre"]).alias("genre"))


@query(f"SELECT ordinal, {ACTORS} AS actors FROM {INFO}")
def first_n_matches(spark, sf):
    return _info(spark, sf).select("ordinal", X.actors(F.col("info"), D["actors"]).alias("actors"))


@query(
    f"""
SELECT ordinal, coalesce(nullif({sql_strip("quote")}, ''), nullif({sql_strip("runtime")}, ''),
  nullif({sql_strip("title")}, ''), '{D["quote"]}') AS quote FROM ({SQL_MOVIES})
"""
)
def coalesce_chain(spark, sf):
    cols = [F.col("quote"), F.col("runtime"), F.col("title")]
    return movies(spark, sf).select("ordinal", X.first_non_empty(*cols, default=D["quote"]).alias("quote"))


@query(
    f"""
SELECT ordinal, title FROM (
  SELECT ordinal, {sql_strip(f"concat({sql_strip('coalesce(title, chr(32))')}, ' ', " + sql_strip("replace(" + sql_strip("concat(' / ', coalesce(quote, ''))") + ", '/', '')") + ")")} AS title
  FROM ({SQL_MOVIES})) WHERE title <> ''
"""
)
def guarded_title(spark, sf):
    other = F.concat(F.lit(" / "), F.coalesce("quote", F.lit("")))
    titled = movies(spark, sf).select("ordinal", X.full_title(F.col("title"), other).alias("title"))
    return titled.where(F.col("title") != "")


@query(
    f"""
WITH kept AS (
  SELECT ordinal, title, coalesce(quote, '{D["quote"]}') AS quote, detail_url,
    coalesce(runtime, '{D["runtime"]}') AS runtime,
    CAST(trunc(coalesce({sql_number("rank_num")}, 0)) AS BIGINT) AS rank_num,
    round_even(coalesce({sql_number("rating")}, 0.0) * 10, 0) / 10 AS rating,
    CAST(trunc(coalesce({sql_number("replace(comment_num, ',', '')")}, 0)) AS BIGINT) AS comment_num,
    coalesce(info, '{D["info"]}') AS info
  FROM ({SQL_MOVIES}) WHERE rank_num IS NOT NULL AND title IS NOT NULL AND rating IS NOT NULL),
full_rows AS (
  SELECT * EXCLUDE (info), {DIRECTOR} AS director, {YEAR} AS year, {GENRE} AS genre, {ACTORS} AS actors,
    row_number() OVER (PARTITION BY title, rating ORDER BY rank_num, ordinal) AS rn FROM kept)
SELECT * EXCLUDE (rn) FROM full_rows WHERE rn = 1 AND rating BETWEEN 0 AND 10
"""
)
def catalogue_clean(spark, sf):
    return clean_movies(movies(spark, sf), ["rank_num", "ordinal"]).drop("info")
