"""Every query with a SQL twin agrees with DuckDB on the sf0.001 tables."""

import os

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data absent")
# co_cluster runs the code of co_cluster_full for fewer rounds; tools/check_oracle.py runs both. The op queries have tests of their own.
@pytest.mark.parametrize("name", sorted(n for n in SQL if n != "co_cluster_full" and not n.startswith("op")))
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF)
    compare(df, con, SQL[name])


def test_every_query_registered():
    assert set(SQL) <= set(E.queries())
    assert len(E.queries()) >= 57


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data absent")
def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["count"] > 0
