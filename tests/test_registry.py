"""Registered queries against DuckDB on the smallest tables."""

import glob
import os

import pytest

import __spark_entry__ as entry
from registry import all_queries, gating, marts, serving

SF = "/root/testdata/sf0.001"
NAMES = [*marts.QUERIES, *serving.QUERIES, "gate_outcomes", "gate_issue_log", "typed_loan_decisions"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_duckdb(spark, duck, name):
    from verify import rows_of

    df = entry.queries()[name](spark, SF)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_every_query_has_its_sql():
    own = all_queries()
    assert own.keys() <= entry.queries().keys()
    assert [name for name, query in own.items() if not query.sql] == []
    assert entry.oracle_sql().keys() <= entry.queries().keys()
    assert gating.QUERIES.keys() <= own.keys()
