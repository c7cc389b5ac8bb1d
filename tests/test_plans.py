"""The physical plans the package counts on."""

import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

from freshet.catalog import QUERIES
from freshet.catalog.base import events
from freshet.operators.selection import anti_seen, enrich, one_per_key
from freshet.operators import skew


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_any_plan(spark, name):
    if name.startswith("ingest_"):
        pytest.skip("covered by the operators it is made of")
    plan = physical(QUERIES[name](spark, SF))
    assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython|MapInPandas|CartesianProduct", plan)
    assert "BroadcastNestedLoopJoin" not in plan


def test_flagship(spark):
    plan = physical(QUERIES["incremental_enrich"](spark, SF))
    assert "LeftAnti" in plan and "WindowGroupLimit" in plan and "BroadcastHashJoin" in plan


def test_scans_read_only_needed_columns(spark):
    plan = physical(QUERIES["cap_per_channel"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in plan
    plan = physical(QUERIES["filter_kind"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_filter_reaches_the_scan(spark):
    plan = physical(QUERIES["state_clear"](spark, SF))
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts," in plan


def test_counts_combine_before_the_shuffle(spark):
    plan = physical(QUERIES["gold_by_category"](spark, SF))
    assert "partial_sum" in plan and plan.count("Exchange hashpartitioning") == 1


def test_copies_are_dropped_before_the_shuffle(spark):
    plan = physical(one_per_key(events(spark, SF), ["user_id"], [F.col("ts").desc()]))
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_small_increment_does_not_shuffle_the_ledger(spark):
    df = events(spark, SF).select("user_id", "event_id")
    plan = physical(anti_seen(df, df, ["user_id", "event_id"], small=True))
    assert "LeftSemi, BuildRight" in plan


def test_large_sides_are_not_broadcast_by_us(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = events(spark, SF).select("user_id", "event_id")
        channels = df.groupBy("user_id").agg(F.max("event_id").alias("name"))
        for plan in (physical(anti_seen(df, df, ["user_id", "event_id"])), physical(enrich(df, channels, "user_id", ["name"]))):
            assert "SortMergeJoin" in plan and "Broadcast" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_path_is_off_for_ordinary_keys(spark):
    assert skew.hot_keys(events(spark, SF), ["event_type"]).frame is None


def test_partitioned_writes_are_rebalanced(spark):
    plan = events(spark, SF).hint("rebalance", F.col("event_type"))._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
