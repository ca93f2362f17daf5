"""Every registered workload against its DuckDB statement on sf0.001; the
rows-only keys (LSA) just have to run."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import duck, rows  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    res = con.sql(ORACLE[name])
    assert sorted(sdf.columns) == sorted(res.columns)
    assert rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows(res.columns, res.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"query_id", "retriever", "rank", "doc_id"} <= set(df.columns)
