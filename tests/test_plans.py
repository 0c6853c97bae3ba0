"""Plan shape of every catalogued query: no Python evaluation, no cartesian
product or nested-loop join, and pushdown where a point filter exists."""

import pytest

from helpers import SF_SMALL

import __spark_entry__ as entry_mod
from permscope.plans import catalog

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF", "MapInArrow", "FlatMapGroupsInArrow",
             "FlatMapCoGroupsInArrow", "FlatMapCoGroupsInPandas", "PythonDataSource")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_plan_has_no_python_or_cross_join(spark, name):
    plan = _plan(entry_mod.queries()[name](spark, SF_SMALL))
    bad = [f for f in FORBIDDEN if f in plan]
    assert not bad, f"{name}: {bad}"


def test_point_lookup_is_pushed_to_parquet(spark):
    from permscope.operators.finders import aces_for_folder
    from permscope.sources import fixtures as fx

    df = aces_for_folder(fx.aces(spark, SF_SMALL), "\\\\filer0.example.com\\bulk\\all")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "folder_path" in plan.split("PushedFilters:")[1].split("]")[0]


def test_rule_scan_reads_only_needed_columns(spark):
    from permscope.operators.rules import apply_rules
    from permscope.sources import fixtures as fx

    plan = _plan(apply_rules(fx.aces(spark, SF_SMALL)))
    schema = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "owner" not in schema and "volume_guid" not in schema


def test_runtime_filters_are_pushed(spark):
    from permscope.operators.finders import runtime_filters
    from permscope.sources import fixtures as fx

    plan = _plan(runtime_filters(fx.aces(spark, SF_SMALL), inherited=False, share="bulk"))
    pushed = plan.split("PushedFilters:")[1].split("]")[0]
    assert "share_name" in pushed and "ace_inherited" in pushed


def test_run_partitions_are_pruned(spark, tmp_path):
    from pyspark.sql import functions as F
    from permscope.sources import fixtures as fx
    from permscope.sources.parquet import read_aces, write_aces

    out = str(tmp_path / "store")
    write_aces(fx.aces_two_runs(spark, SF_SMALL), out)
    df = read_aces(spark, out, run_ids=["run-b"])
    plan = _plan(df)
    assert "PartitionFilters: [" in plan and "run-b" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert df.select(F.countDistinct("run_id")).first()[0] == 1
