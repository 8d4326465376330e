"""Every registered query against its DuckDB oracle on the same tables."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare

NAMES = sorted(E._QUERIES)  # those of tests/llm are tested there


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_small, name):
    ok, msg = compare(spark, sf_small, name, E.queries()[name], E.oracle_sql().get(name))
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["week", "total"]
    assert len(rows) == 7
