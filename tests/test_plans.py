"""Plan properties the scale design relies on."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_values_limits_groups_before_shuffle(spark):
    plan = _plan(E.queries()["top_values"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_key_check_aggregates_map_side(spark):
    plan = _plan(E.queries()["feature_key_violations"](spark, SF_SMALL))
    assert "partial_count" in plan


def test_scan_reads_only_needed_columns_and_pushes_filter(spark):
    from pyspark.sql import functions as F

    from attrix.plans.frames import frames

    df = frames(spark, SF_SMALL).service_features.filter(F.col("PaymentMethod") == "BUILDING") \
        .select("customerID")
    plan = _plan(df)
    assert "EqualTo(c_mktsegment,BUILDING)" in plan   # reaches PushedFilters
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in plan


@pytest.mark.parametrize("name", ["churn_by_segment", "feature_lookup", "feature_lookup_multi",
                                  "event_feature_lookup", "histogram", "summary_stats",
                                  "stratified_split", "data_profile"])
def test_no_cartesian_or_nested_loop_joins(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
