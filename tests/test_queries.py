"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import pytest
from compare import compare, connect
from conftest import SMALL

import __spark_entry__ as entry
from dailymart import oracle, registry

QUERIES, ORACLE = registry.all_queries(), oracle.all_queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    assert compare(spark, duck, QUERIES[name], ORACLE[name], SMALL) is None


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 51
    assert df.limit(1).count() == 1
