"""Every registered query runs at sf0.001 and equals its DuckDB oracle
(the driver's correctness gate, run locally on the smallest tables)."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from panelkit.plans.registry import load_all
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
# The queries over the star schema; the corpus queries have their own tests.
QUERIES = {name: fn for name, (fn, _) in load_all().items()}
ORACLE = {name: sql for name, (_, sql) in load_all().items() if sql}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_returns_rows(spark):
    df = entry(spark)
    assert df.count() > 0 and "target_available" in df.columns


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    msg = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert msg is None, msg


def test_shared_table_is_written_once_per_state_of_its_inputs(spark, tmp_dir):
    import os

    from panelkit.plans.tables import shared_table

    calls = []

    def build():
        calls.append(1)
        return spark.range(5).withColumnRenamed("id", "x")

    a = shared_table(spark, tmp_dir, "t", build)
    b = shared_table(spark, tmp_dir, "t", build)
    assert a is b and len(calls) == 1 and sorted(r.x for r in a.collect()) == [0, 1, 2, 3, 4]
    assert "parquet" in a._jdf.queryExecution().executedPlan().toString().lower()
    with open(os.path.join(tmp_dir, "more.parquet"), "w") as file:
        file.write("x")
    assert shared_table(spark, tmp_dir, "t", build) is not a and len(calls) == 2
