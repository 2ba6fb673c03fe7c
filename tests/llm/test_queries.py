"""The registered queries of the subpackage: names, and their SQL where there is one."""

import re

import duckdb
import pytest

import __spark_entry__ as spark_entry
from reviewlens.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    numbers = {int(m[1]) for m in (re.match(r"op(\d+)_", name) for name in QUERIES) if m}
    assert numbers >= set(range(1, 11)) and "pipeline" in QUERIES
    assert set(QUERIES) <= set(spark_entry.queries()) and set(ORACLE) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for name_ in ("documents", "embeddings", "labels"):
        con.sql(f"CREATE VIEW {name_} AS SELECT * FROM '{SF}/{name_}.parquet'")
    got = QUERIES[name](spark, SF).toPandas()
    want = con.sql(ORACLE[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = lambda df: sorted(df[columns].itertuples(index=False, name=None))
    assert rows(got) == rows(want) and len(got) > 0
