"""Results stay right and whole when one key holds about a third of every table."""

from __future__ import annotations

import shutil

import pytest

from checks.compare import TABLES, difference, duck
from checks.queries import ORACLE
from martlet.plans.catalog import QUERIES
from martlet.sources.registry import derived_sources
from tests.conftest import SF_DIR

SKEWED = {
    "lineitem": "* REPLACE (CASE WHEN hash(l_partkey, l_suppkey, l_shipdate) % 3 = 0 THEN 7 ELSE l_orderkey END "
    "AS l_orderkey, CASE WHEN hash(l_orderkey, l_shipdate) % 3 = 0 THEN 3 ELSE l_partkey END AS l_partkey)",
    "orders": "* REPLACE (CASE WHEN hash(o_orderkey) % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey, "
    "CASE WHEN hash(o_orderkey, 1) % 3 = 0 THEN TIMESTAMP '1998-05-05' ELSE o_orderdate END AS o_orderdate)",
    "events": "* REPLACE (CASE WHEN hash(event_id) % 3 = 0 THEN 2 ELSE user_id END AS user_id)",
}

QUERIES_UNDER_SKEW = [
    "stg_order_items", "stg_marketing_attribution", "fct_marketing_attribution", "time_decay_normalised",
    "fct_orders", "fct_orders_positional", "fct_daily_revenue", "fct_pipeline", "int_customer_ltv",
    "int_funnel_stages", "fct_lead_scoring_features", "dim_customers", "dim_products", "top_categories",
    "revenue_by_state", "ga4_channel_summary", "fct_marketing_daily", "build_touchpoints",
    "deal_stage_at_touch", "touch_sessions", "metric_cube", "reference_report", "attribute_by_channel",
    "event_attributes", "places_changed", "evaluate", "stump_scores", "deal_age_bands", "marketing_daily_increments",
    "assign_touch_credits", "contacts_rollup", "lead_features", "detect_anomalies", "kpi_summary",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    base = tmp_path_factory.mktemp("skewed")
    con = duck(SF_DIR)
    for name in TABLES:
        target = base / f"{name}.parquet"
        if name in SKEWED:
            con.execute(f"COPY (SELECT {SKEWED[name]} FROM {name}) TO '{target}' (FORMAT parquet)")
        else:
            shutil.copyfile(f"{SF_DIR}/{name}.parquet", target)
    con.close()
    return str(base)


@pytest.mark.parametrize("name", QUERIES_UNDER_SKEW)
def test_hot_keys(spark, skewed, name):
    df = QUERIES[name](derived_sources(spark, skewed))
    assert difference(df, duck(skewed), ORACLE[name]) is None
