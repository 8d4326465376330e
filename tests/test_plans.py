"""Plan shape: no Python UDF nodes, pruned scans, partial aggregation, broadcast bound."""

import pytest

import __spark_entry__ as E

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["ride_by_product", "ride_by_weekday", "ride_price_bands", "ride_etl",
                                  "encode_messages", "ipv4_range_tally", "lake_snapshot", "lake_as_of"])
def test_no_python_in_plan(spark, sf_small, name):
    plan = _plan(E.queries()[name](spark, sf_small))
    assert not any(n in plan for n in PY_NODES), plan


def test_reports_prune_columns_and_aggregate_partially(spark, sf_small):
    df = E.queries()["ride_by_product"](spark, sf_small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_linenumber:int>" in plan
    assert "partial_count" in plan


def test_range_join_broadcasts_the_bounded_side(spark, sf_small):
    df = E.queries()["ipv4_range_tally"](spark, sf_small)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_snapshot_reduces_partially_before_shuffle(spark, sf_small):
    df = E.queries()["lake_snapshot"](spark, sf_small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    # only the selected columns (plus identity/order/op) are read
    assert "begin_lat" not in plan.split("ReadSchema:")[1].split("\n")[0]
