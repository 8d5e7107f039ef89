"""Plan-shape assertions: pushdown, pruning, broadcast, partial top-k,
no Python UDF on built-in paths."""

from __future__ import annotations

import pytest

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def qs():
    return queries()


def test_filter_reaches_scan(spark, qs):
    p = plan(qs["membership_filter"](spark, SF))
    assert "PushedFilters: [In(o_orderpriority" in p


def test_projection_is_pruned(spark, qs):
    p = plan(qs["normalize_text"](spark, SF))
    scans = [s for s in p.split("\n") if "ReadSchema" in s]
    assert scans and all("lang" not in s and "n_chars" not in s for s in scans)


def test_no_python_udf_on_builtin_paths(spark, qs):
    for name in ["normalize_text", "monthly_feature_panel", "title_case", "payload_validation",
                 "grid_tidy_table", "descriptive_stats"]:
        p = plan(qs[name](spark, SF))
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_dimension_join_is_broadcast(spark, qs):
    p = plan(qs["dimension_lookup"](spark, SF))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_top_k_limits_before_shuffle(spark, qs):
    df = qs["top_k_per_group"](spark, SF)
    p = df._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in p and "Partial" in p


def test_latest_per_key_is_partial_aggregate(spark, qs):
    p = df_plan = qs["latest_per_key"](spark, SF)._jdf.queryExecution().sparkPlan().toString()
    assert "max_by" in p and "Window" not in df_plan


def test_lags_use_joins_not_windows(spark, qs):
    p = qs["monthly_lags"](spark, SF)._jdf.queryExecution().sparkPlan().toString()
    assert "Window" not in p


def test_flagship_reads_orders_at_most_twice(spark, qs):
    p = plan(qs["monthly_feature_panel"](spark, SF))
    scans = [line for line in p.split("\n") if "FileScan parquet" in line and "o_orderdate" in line]
    assert 1 <= len(scans) <= 2, len(scans)
