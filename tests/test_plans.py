"""Plan shapes that carry the scale argument: pushdown, partial top-k,
partial aggregation, and the only explicit broadcast being the scan's
bounded carry table."""

import pytest

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = queries()[name](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    return text


def test_bounded_scan_pushes_the_time_filter(spark):
    p = plan(spark, "bounded_scan")
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts," in p


def test_top3_limits_before_the_shuffle(spark):
    p = plan(spark, "top3_mean")
    assert "WindowGroupLimit" in p


@pytest.mark.parametrize("name", ["hourly_best_user", "word_count", "long_rides", "key_count"])
def test_aggregations_are_two_phase(spark, name):
    p = plan(spark, name)
    assert "partial_" in p


@pytest.mark.parametrize("name", ["fraud_alerts", "running_count", "silence_counts_60s", "rolling_hour_best",
                                  "ride_fare_match", "timed_match"])
def test_keyed_scans_shuffle_once_and_broadcast_only_the_carry(spark, name):
    p = plan(spark, name)
    assert "rangepartitioning" not in p and "InMemoryTableScan" not in p
    joins = [ln for ln in p.splitlines() if "BroadcastHashJoin" in ln]
    assert joins and all("_k_" in ln for ln in joins)
    # the rows meet their chunk in one shuffle by number; below it no window sorts them again
    main = p[:p.index("BroadcastExchange")]
    assert main.count("REPARTITION_BY_NUM") == 1 and "ENSURE_REQUIREMENTS" not in main.split("REPARTITION_BY_NUM")[0]


def test_scans_read_only_needed_columns(spark):
    p = plan(spark, "fraud_alerts")
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in p
