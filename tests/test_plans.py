"""Shapes of the physical plans, with broadcasting off as for large tables."""

from __future__ import annotations

import re

import pytest

from martlet.plans.catalog import QUERIES
from martlet.sources.registry import derived_sources
from tests.conftest import SF_DIR

NEEDS_A_RUN = {
    "train_lead_model", "evaluate", "score_leads", "saved_model", "run_log", "routed_leads",
    "traffic_windows_stream", "late_events_stream", "touch_sessions_stream",
    "read_csv_table", "write_table", "append", "run_checks_staging", "run_checks_marts",
    "stump_scores", "marketing_daily_increments",
}


@pytest.fixture
def large(spark):
    """A session that may not broadcast by size."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(spark, name: str) -> str:
    df = QUERIES[name](derived_sources(spark, SF_DIR))
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_query_pairs_all_rows_or_broadcasts_blindly(large):
    for name in QUERIES:
        if name in NEEDS_A_RUN:
            continue
        text = plan(large, name)
        assert not re.search(r"CartesianProduct|NestedLoopJoin|BroadcastExchange", text), name
        # a window without a partition would bring all rows into one task
        for line in text.splitlines():
            if "- Window [" in line:
                assert not line.rstrip().endswith("[]"), name
                # a constant partition key is an empty one in disguise
                assert re.search(r"\], \[[^\]]*#", line), name
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name


def test_no_job_runs_before_an_action(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building plans")
    for name in QUERIES:
        if name not in NEEDS_A_RUN:
            QUERIES[name](derived_sources(spark, SF_DIR))
    jobs = tracker.getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs


def test_sides_of_the_order_fact_share_one_partitioning(large):
    text = plan(large, "fct_orders")
    assert text.count("Exchange hashpartitioning(order_id") <= 6
    assert len(re.findall(r"SortMergeJoin \[order_id", text)) >= 5


def test_the_flagship_shuffles_its_rows_twice(large):
    """By slice to number them and by order to join; the rest are counts by slice, orders and channels."""
    text = plan(large, "fct_marketing_attribution")
    by = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text)
    assert len(by) <= 7 and sum("_at" in b for b in by) == 2


def test_items_are_not_numbered_for_nothing(large):
    for name in ("dim_products", "top_categories"):
        assert "_at" not in plan(large, name)
    # the order fact numbers its touches only
    assert len(re.findall(r"SortMergeJoin \[_at", plan(large, "fct_orders"))) == 1


def test_touchpoints_join_on_equality_only(large):
    text = plan(large, "build_touchpoints")
    joins = [line for line in text.splitlines() if "Join" in line]
    assert len(joins) == 1 and "customer_id" in joins[0] and "order_date" in joins[0]


def test_only_used_columns_are_read(large):
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan(large, "payment_distribution"))
    assert scans and all("o_custkey" not in s for s in scans)
    (scan,) = re.findall(r"ReadSchema: struct<([^>]*)>", plan(large, "ga4_by_device"))
    assert {c.split(":")[0] for c in scan.split(",")} == {"event_id", "ts", "user_id", "event_type"}


def test_totals_share_the_shuffle_they_sum(large):
    for name in ("share_of_total", "payment_share", "channel_share", "contacts_summary"):
        df = QUERIES[name](derived_sources(large, SF_DIR))
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "ReusedExchange" in final, name
