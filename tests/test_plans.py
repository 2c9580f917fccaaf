"""Plan assertions: no Python evaluation, no cartesian products, filters reach the
Parquet scan, small dimensions are broadcast, dedup uses the group limit."""

import re

import pytest

from ledgerflow.plans.queries import QUERIES

from conftest import SF_SMALL

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_no_cartesian(spark, key):
    plan = plan_of(QUERIES[key](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, (key, bad)


def test_window_filter_reaches_scan(spark):
    plan = plan_of(QUERIES["metric_row_count"](spark, SF_SMALL))
    scans = [l for l in plan.splitlines() if "FileScan parquet" in l]
    assert any(re.search(r"PushedFilters: \[.*processed_at", l) for l in scans), scans
    plan = plan_of(QUERIES["daily_volume"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[.*transaction_timestamp", plan)


def test_column_pruning(spark):
    plan = plan_of(QUERIES["daily_volume"](spark, SF_SMALL))
    scan = [l for l in plan.splitlines() if "FileScan parquet" in l][0]
    assert "ReadSchema: struct<transaction_timestamp:timestamp_ntz>" in scan


def test_small_dimensions_broadcast(spark):
    plan = plan_of(QUERIES["fact_load"](spark, SF_SMALL))
    assert plan.count("BroadcastHashJoin") >= 2


def test_star_rollup_preaggregates(spark):
    plan = plan_of(QUERIES["star_rollup"](spark, SF_SMALL))
    # the fact is aggregated before the dimension joins
    first_join = plan.find("BroadcastHashJoin")
    assert "partial_count" in plan[first_join:]


def test_dedup_group_limit(spark):
    assert "WindowGroupLimit" in plan_of(QUERIES["stage_clean"](spark, SF_SMALL))


def test_hot_key_lookup(spark):
    from pyspark.sql import functions as F
    from ledgerflow.operators.joins import lookup_join
    facts = spark.range(0, 20000).select((F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500))
                                         .alias("k"), F.col("id"))
    dim = spark.range(0, 400).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    split = lookup_join(facts, dim, "k", "left", hot_rows=1000)
    plain = facts.join(dim, "k", "left")
    assert split.count() == plain.count() == 20000
    assert split.exceptAll(plain).count() == 0
    hot = split.where("k = 7").agg(F.count(F.lit(1)), F.max("v")).first()
    assert hot[0] >= 6667 and hot[1] == 70
