"""Registration, table access and SQL fragments shared by the checked queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions import patterns as P

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Movie records made from every row of part, in SQL both engines read alike. They carry the cases
# the cleaner has to deal with: missing and malformed values, one-line infos, repeated titles.
MOVIES = """
SELECT p_partkey AS ordinal,
  CASE WHEN p_partkey % 41 = 0 THEN NULL ELSE CAST(p_partkey + 1 AS STRING) END AS rank_num,
  CASE WHEN p_size % 47 = 0 THEN NULL WHEN p_size % 43 = 0 THEN '' ELSE concat(p_name, ' ', p_type) END AS title,
  CASE WHEN p_size % 13 = 0 THEN 'abc' WHEN p_size % 11 = 0 THEN concat(' ', CAST(p_size AS STRING), '.0 ')
       WHEN p_size % 17 = 0 THEN 'NaN' WHEN p_size % 37 = 0 THEN ''
       ELSE concat(CAST(CAST(FLOOR(p_size / 6.0) AS INT) AS STRING), '.', CAST(p_size % 10 AS STRING), '5')
  END AS rating,
  CASE WHEN p_size % 7 = 0 THEN NULL
       ELSE concat(CAST(p_size AS STRING), ',', CAST(p_partkey % 900 + 100 AS STRING)) END AS comment_num,
  CASE WHEN p_size % 19 = 0 THEN NULL
       WHEN p_size % 5 = 0 THEN concat(p_name, ' ', CAST(1950 + p_size AS STRING), ' / ', p_brand, ' / ', p_type)
       WHEN p_size % 3 = 0 THEN concat('导演: ', p_brand, ' x 主演: ', p_type, ' / ', p_name, chr(10), 'n.d.')
       ELSE concat('导演: ', translate(replace(p_brand, 'Brand#', ''), '0123456789', '零一二三四五六七八九'),
                   '·甲 A  主演: 丁一 Cee / 戊二·己 Dee / ',
                   translate(CAST(p_size AS STRING), '0123456789', '零一二三四五六七八九'), ' / 辛四', chr(10),
                   '   ', CAST(1950 + p_size AS STRING), ' / 某国 /  ', p_name, ' ') END AS info,
  CASE WHEN p_size % 9 = 0 THEN NULL WHEN p_size % 8 = 0 THEN '' ELSE concat(' ', p_name, ' ') END AS quote,
  concat('https://movies.example.com/subject/', CAST(p_partkey AS STRING), '/') AS detail_url,
  CASE WHEN p_size % 4 = 0 THEN NULL ELSE '' END AS runtime
FROM {part}
"""


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MOVIES, part=table(spark, sf_dir, "part"))


# Fragments of DuckDB SQL. Its regular expressions want white space spelled out.
SPACE = (
    r"\t\n\x{000B}\f\r \x{001C}-\x{001F}\x{0085}\x{00A0}\x{1680}"
    r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WORD = f"[^{SPACE}]+"
SQL_MOVIES = MOVIES.format(part="part")


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def sql_collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{SPACE}]+', ' ', 'g'), ' ')"


def sql_clean(x: str, keep: str) -> str:
    return sql_collapse(f"regexp_replace(coalesce({x}, ''), '[^{keep}{SPACE}]', '', 'g')")


def sql_runs(x: str) -> str:
    return f"regexp_extract_all({x}, '[{P.CJK}]+|[^{P.CJK}{SPACE}]+')"


def sql_number(x: str) -> str:
    return f"(CASE WHEN regexp_matches({sql_strip(x)}, '{P.NUMBER}') THEN TRY_CAST({sql_strip(x)} AS DOUBLE) END)"


def sql_uniform(x: str) -> str:
    return f"(CAST(concat('0x', left(md5({x}), 13)) AS BIGINT) / 4503599627370496.0::DOUBLE)"


def sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)
