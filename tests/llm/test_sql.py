"""Queries against their SQL."""

import glob
import os

import duckdb
import pytest

from waitlens.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, small, name):
    con = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    want = con.execute(ORACLE_SQL[name]).df()
    got = QUERIES[name](spark, small).toPandas()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)

    def rows(df):
        return sorted(map(tuple, df[columns].astype(object).values.tolist()), key=str)

    assert rows(got) == rows(want)
