"""Every registered query next to its SQL twin."""

import pytest

import __spark_entry__ as entry
from tesselar.plans.queries import QUERIES as REGISTERED
from tests.session import assert_same_rows, duckdb_tables

SF_DIR = "/root/testdata/sf0.001"
# The queries of tesselar.llm have tests of their own in tests/llm.
QUERIES = {name: query for name, query in entry.queries().items() if name in REGISTERED}
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name in REGISTERED}


@pytest.fixture(scope="module")
def tables():
    return duckdb_tables(SF_DIR)


def test_every_query_has_a_twin():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, tables, name):
    result = QUERIES[name](spark, SF_DIR)
    assert_same_rows(result, tables.execute(ORACLE[name]).df())
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert [row["iteration"] for row in rows] == [0]
