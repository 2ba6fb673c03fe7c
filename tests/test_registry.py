"""Every registered query against its SQL in DuckDB."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as spark_entry
from reviewlens.registry import ORACLE, QUERIES
from reviewlens.registry.base import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list:
    def plain(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
            return None
        return v

    listed = [tuple(plain(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False, name=None)]
    return sorted(listed, key=lambda r: tuple("0" if v is None else f"1{v}" for v in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
    assert len(got) > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(spark_entry.queries()) and set(ORACLE) <= set(spark_entry.oracle_sql())


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 20


@pytest.mark.parametrize("name", ["dedup_first", "page_accumulate", "histogram20", "sentiment_score", "surrogate_key"])
def test_partitioning_does_not_matter(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        few = rows(QUERIES[name](spark, SF).toPandas())
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        many = rows(QUERIES[name](spark, SF).toPandas())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert few == many
