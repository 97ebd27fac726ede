"""Every query of the subpackage that has SQL equals it at the smallest scale."""

import duckdb
import pytest
from odd import FOLDER

from check import normal
from massloom.catalog.inputs import TABLES
from massloom.llm.catalog import oracle_sql, queries


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    got, want = queries()[name](spark, FOLDER).toPandas(), con.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)
