"""The metric query function."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martlet.operators.marts import fct_marketing_attribution
from martlet.operators.panels import ga4_weekly_by_channel, linear_share, sessions_pivot
from martlet.plans.metrics import METRICS, MODELS, Derived, query_metric
from martlet.sources.adapters import CHANNEL_GROUPS


def test_definitions_are_closed():
    for metric in METRICS.values():
        if isinstance(metric, Derived):
            assert {metric.numerator, metric.denominator} <= set(METRICS)
        else:
            assert metric.model in MODELS


def test_unknown_dimension_and_time(src):
    with pytest.raises(ValueError, match="no dimension"):
        query_metric(src, ["total_spend"], group_by=["channel"])
    with pytest.raises(ValueError, match="no time"):
        query_metric(src, ["channel_spend"], grain="week")


def test_ratio_of_sums_not_mean_of_ratios(src):
    whole = query_metric(src, ["engagement_rate"]).first().engagement_rate
    by_day = query_metric(src, ["total_engaged_sessions", "total_sessions"], grain="day")
    top, bottom = by_day.agg(F.sum("total_engaged_sessions"), F.sum("total_sessions")).first()
    assert whole == top / bottom


def test_time_range_and_grains_agree(src):
    days = query_metric(src, ["total_sessions"], grain="day").orderBy("metric_time").collect()
    low, high = days[2].metric_time, days[8].metric_time
    got = query_metric(src, ["total_sessions"], start=low, end=high).first().total_sessions
    assert got == sum(d.total_sessions for d in days[2:9])


def test_lean_and_full_order_model_agree(src):
    lean = query_metric(src, ["total_revenue", "total_orders"]).first()
    full = query_metric(src, ["total_revenue", "total_orders"], where="order_id IS NOT NULL").first()
    assert tuple(lean) == tuple(full)


def test_credits_sum_to_revenue(src):
    touches = src.table("marketing_attribution")
    revenue = touches.filter("touchpoint_position = 1").agg(F.sum("order_revenue")).first()[0]
    sums = fct_marketing_attribution(src).agg(
        *[F.sum(c) for c in ("first_touch_revenue", "last_touch_revenue", "linear_revenue")]
    ).first()
    assert sums[0] == pytest.approx(revenue, abs=0.1) and sums[1] == pytest.approx(revenue, abs=0.1)
    assert sums[2] == pytest.approx(revenue, rel=1e-3)


def test_pivot_and_shares_keep_totals(src):
    wide = sessions_pivot(src, CHANNEL_GROUPS).agg(*[F.sum(c) for c in CHANNEL_GROUPS]).first()
    assert sum(wide) == ga4_weekly_by_channel(src).agg(F.sum("sessions")).first()[0]
    assert linear_share(src).agg(F.sum("share_pct")).first()[0] == pytest.approx(100.0, abs=1e-4)
