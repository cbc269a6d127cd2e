"""The driver contract and every registered query against its DuckDB oracle."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tools.verify_oracle import compare, duckdb_connection  # noqa: E402

from .conftest import SF_SMALL

# The text operators, where they are there, have their own tests.
CORE = sorted(entry.QUERIES)


def test_entry_runs_with_stable_schema(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["client_id", "date"] and len(df.columns) == 15
    assert entry.entry(spark).schema == df.schema


def test_every_query_has_an_oracle():
    assert set(CORE) <= set(entry.queries()) & set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", CORE)
def test_query_matches_oracle(spark, duck, name):
    res = compare(spark, duck, name, entry.queries()[name], entry.oracle_sql().get(name), SF_SMALL)
    assert res["status"] in ("match", "rows-only"), res
    assert res["spark_rows"] > 0
