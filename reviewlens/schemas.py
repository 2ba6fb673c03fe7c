"""Schemas, defaults and fixed values of the catalogue and review tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# Numbers stay strings until the cast operator has seen them, so bad values survive the scan.
RAW_MOVIES = T.StructType(
    _strings(
        "rank_num",
        "title",
        "rating",
        "comment_num",
        "info",
        "quote",
        "detail_url",
        "poster_path",
        "year",
        "runtime",
        "imdb",
    )
)

REVIEWS = T.StructType(
    [
        T.StructField("ordinal", T.LongType()),
        T.StructField("movie_rank", T.IntegerType()),
        *_strings("username", "rating", "content", "comment_time"),
    ]
)

COMMENT = T.StructType(_strings("author", "score", "time", "content"))

ITEMS = T.StructType(
    _strings(
        "rank",
        "title_cn",
        "title_en",
        "rating",
        "rating_count",
        "directors_cast",
        "quote",
        "detail_link",
        "year",
        "duration",
        "genre",
        "imdb_rating",
        "poster_url",
        "poster_path",
        "crawled_at",
        "spider_name",
    )
    + [T.StructField("hot_comments", T.ArrayType(COMMENT))]
)

RUNS = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("execution_time", T.DoubleType()),
        T.StructField("memory_used", T.DoubleType()),
        T.StructField("data_count", T.LongType()),
        T.StructField("db_size_mb", T.DoubleType()),
        T.StructField("movies", T.LongType()),
        T.StructField("comments", T.LongType()),
    ]
)

# Columns that must be present in a movie record.
REQUIRED_MOVIE = ["rank_num", "title", "rating"]

# What replaces NULL in a movie record.
MOVIE_DEFAULTS = {
    "quote": "无经典台词",
    "info": "无详细信息",
    "comment_num": "0",
    "detail_url": "",
    "year": "未知年份",
    "runtime": "未知片长",
    "imdb": "",
    "director": "未知导演",
    "genre": "未知类型",
    "actors": "未知主演",
}

# Fields every crawled item should carry.
REQUIRED_ITEM = ["rank", "title_cn", "rating", "detail_link"]

# A review without a rating, in the flat and in the nested form.
NO_RATING_FLAT = "无评分"
NO_RATING_NESTED = ""

# Longest text each stored column takes.
MOVIE_LIMITS = {
    "title": 255,
    "detail_url": 512,
    "poster_path": 512,
    "year": 10,
    "runtime": 20,
    "imdb": 20,
    "genre": 255,
    "director": 255,
}
MOVIE_NOT_NULL = ["rank_num", "title", "rating"]
COMMENT_LIMITS = {"username": 100, "rating": 20, "time": 50}
COMMENT_NOT_NULL = ["movie_id", "content"]

# The stored tables, without their id and load time.
MOVIES_TABLE = T.StructType(
    [
        T.StructField("rank_num", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("comment_num", T.LongType()),
        *_strings(
            "info", "quote", "detail_url", "poster_path", "year", "runtime", "imdb", "genre", "director", "actors"
        ),
    ]
)
COMMENTS_TABLE = T.StructType(
    [T.StructField("movie_id", T.IntegerType()), *_strings("username", "rating", "content", "time")]
)

# What a stored column holds when a load does not bring it.
MOVIES_ABSENT = {
    "comment_num": 0, "detail_url": "", "poster_path": "", "year": "", "runtime": "", "imdb": "", "genre": "",
    "director": "",
}
COMMENTS_ABSENT = {"username": "", "rating": "", "time": ""}

# Sentiment class names and their bounds.
POSITIVE, NEUTRAL, NEGATIVE = "正面", "中性", "负面"
POSITIVE_ABOVE, NEGATIVE_BELOW = 0.7, 0.3
NEUTRAL_SCORE = 0.5

# Phrases that mark a blocked page.
BLOCK_PHRASES = ["检测到异常访问", "验证"]

# Review paging.
REVIEWS_PER_MOVIE = 15
MAX_REVIEW_PAGES = 3
LIST_CAP, LIST_STEP = 250, 25

# Words left out of the keyword list.
KEYWORD_STOP_WORDS = [
    "的", "了", "是", "我", "你", "他", "它", "都", "也", "和", "就", "不", "在", "有",
    "这", "那", "而", "于", "之", "但", "却", "还", "又", "只", "更", "很", "最",
    "一个", "一部", "一点", "一些", "所有", "任何", "没有", "可以", "可能", "应该", "因为",
    "所以", "虽然", "但是", "如果", "那么", "比如", "例如", "就是", "只是", "不过", "其实",
]
