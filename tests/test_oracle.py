"""Every registered query that has a SQL equivalent against DuckDB on the smallest tables."""

from __future__ import annotations

import pytest
from oracle import compare, connect

from tidemark.plans import catalog

FOLDER = "/root/testdata/sf0.001"
QUERIES = catalog()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_matches_sql(spark, con, name):
    problem = compare(spark, con, QUERIES[name].run, QUERIES[name].sql, FOLDER)
    assert problem in (None, "no rows on either side"), problem


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if not q.sql])
def test_runs(spark, name):
    assert QUERIES[name].run(spark, FOLDER).count() > 0


def test_entry_has_a_stable_schema(spark):
    from __spark_entry__ import entry

    assert entry(spark).columns == ["o_custkey", "month", "day", "amount"]
