"""Hand-made edge rows."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from martlet.functions import metrics as fm
from martlet.functions.frames import merge_on, normalise_attribution, share_of_total
from martlet.functions.numeric import half_up
from martlet.operators import insights, panels, platform_tools
from martlet.operators.builders import build_touchpoints
from martlet.operators.intermediate import customer_segment, date_spine, int_dates, time_spine
from martlet.operators.marts import fct_channel_performance, fct_daily_revenue, fct_pipeline
from martlet.operators.staging import stg_ga4_sessions, stg_hubspot_deals, stg_orders
from tests.conftest import rows

GA4 = """date date, channel_group string, device_category string, sessions long, engaged_sessions long,
    bounce_rate double, avg_session_duration_sec double, pages_per_session double, new_users long,
    conversions long, revenue double, conversion_rate double"""
DAY = date(2024, 1, 1)


def one(df):
    (row,) = df.collect()
    return row


def value(spark, column):
    return one(spark.range(1).select(column.alias("v"))).v


def test_zero_sessions(spark, tables):
    row = (DAY, "direct", "mobile", 0, 0, 0.0, 0.0, 0.0, 0, 0, 0.0, 0.0)
    src = tables(ga4_daily_sessions=spark.createDataFrame([row], GA4))
    assert one(stg_ga4_sessions(src)).engagement_rate is None
    assert value(spark, fm.session_cvr(F.lit(0), F.lit(0))) == 0.0
    assert one(platform_tools.ga4_traffic_by_channel(src)).conversion_rate is None


def test_zero_cost_gives_zero_roas(spark):
    assert value(spark, fm.google_roas(F.lit(3), F.lit(0.0))) == 0.0
    assert value(spark, fm.google_roas(F.lit(3), F.lit(None).cast("double"))) == 0.0
    assert value(spark, fm.google_roas(F.lit(7), F.lit(300.0))) == 2.33


def test_empty_close_date(spark, tables):
    deals = spark.createDataFrame(
        [("d1", "o1", "n", "qualified", "default", 1.0, "2024-01-01", "", "new", "email"),
         ("d2", "o2", "n", None, "default", 1.0, "2024-01-01", "2024-02-01", "new", "email")],
        "deal_id string, order_id string, deal_name string, deal_stage string, pipeline string, amount double, "
        "create_date string, close_date string, deal_type string, lead_source string",
    )
    got = {r.deal_id: r for r in stg_hubspot_deals(tables(hubspot_deals=deals)).collect()}
    assert got["d1"].close_date is None and got["d1"].is_closed_won is False
    assert got["d2"].close_date == date(2024, 2, 1) and got["d2"].is_closed_won is False


def _order(key, bought, delivered, status="delivered", customer="c1"):
    return (key, customer, status, bought, None, None, delivered, datetime(2024, 1, 10))


ORDERS = """order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz,
    order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz,
    order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"""


def test_delivery_days_count_calendar_days(spark, tables):
    orders = spark.createDataFrame(
        [
            _order("late_evening", datetime(2024, 1, 1, 23), datetime(2024, 1, 2, 1)),
            _order("open", datetime(2024, 1, 1), None),
            _order("late", datetime(2024, 1, 1), datetime(2024, 1, 11)),
            _order("unknown", None, None),
        ],
        ORDERS,
    )
    got = {r.order_id: (r.delivery_days, r.is_late_delivery) for r in stg_orders(tables(orders=orders)).collect()}
    assert got == {"late_evening": (1, False), "open": (None, False), "late": (10, True)}


def test_first_day_counts_each_customer_once(spark, tables):
    orders = spark.createDataFrame(
        [
            _order("a", datetime(2024, 1, 1), None),
            _order("b", datetime(2024, 1, 1, 5), None),
            _order("c", datetime(2024, 1, 2), None),
            _order("d", datetime(2024, 1, 2), None, customer="c2"),
            _order("e", datetime(2024, 1, 2), None, status="shipped", customer="c3"),
        ],
        ORDERS,
    )
    payments = spark.createDataFrame(
        [("a", 1, "boleto", 1, 10.0), ("a", 2, "voucher", 1, 5.0), ("d", 1, "boleto", 1, 1.0)],
        "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double",
    )
    got = rows(fct_daily_revenue(tables(orders=orders, order_payments=payments)))
    assert got == {(DAY, 2, 15.0, 7.5, 1, 1), (date(2024, 1, 2), 2, 1.0, 0.5, 2, 1)}


def test_unknown_revenue(spark):
    none = F.lit(None).cast("double")
    assert value(spark, customer_segment(none, F.lit(1))) == "new"
    assert value(spark, panels.revenue_bucket(none)) == "$2.5K+"
    assert value(spark, panels.revenue_bucket(F.lit(100.0))) == "$100–250"
    assert value(spark, customer_segment(F.lit(500.0), F.lit(1))) == "vip"


def _series(spark, values):
    data = [(DAY + timedelta(days=i), "direct", v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "date date, channel_group string, sessions long")


def test_anomalies_need_seven_days_before(spark):
    found = lambda v: insights.detect_anomalies(_series(spark, v), "date", "sessions", "channel_group").collect()
    assert found([10] * 6 + [100]) == []
    (hit,) = found([10] * 7 + [100])
    assert (hit.date, hit.prior_avg, hit.pct_change, hit.direction) == (DAY + timedelta(days=7), 10.0, 9.0, "spike")
    assert found([10] * 7 + [13]) == []
    assert [r.direction for r in found([10] * 7 + [6])] == ["drop"]


def test_rolling_average_is_short_at_the_start(spark):
    got = insights.rolling_avg(_series(spark, [1, 2, 4, 4]), "date", "sessions", "channel_group", w=2)
    assert [r.rolling_avg for r in got.orderBy("date").collect()] == [1.0, 2.0, 3.0, 4.0]


def test_tiers_are_strict(spark):
    tier = lambda v: value(spark, fm.lead_tier(F.lit(v)))
    assert [tier(v) for v in (0.81, 0.8, 0.5, 0.51)] == ["A", "B", "C", "B"]
    assert [value(spark, fm.campaign_status(F.lit(v))) for v in (3.0, 2.99, 1.0, 0.99)] == [
        "Scale", "Watch", "Watch", "Pause",
    ]
    assert [value(spark, fm.cvr_tier(F.lit(v))) for v in (3.5, 2.0, 1.99)] == ["good", "mid", "low"]
    assert [value(spark, fm.roas_tier(F.lit(v))) for v in (8.0, 3.0, 2.99)] == ["high", "mid", "low"]


def test_null_group_keys_are_dropped(spark, tables):
    cols = (
        "date date, campaign_id string, campaign_name string, campaign_type string, impressions long, clicks long, "
        "cost double, conversions long, conversion_value double, ctr double, avg_cpc double, "
        "cost_per_conversion double, roas double"
    )
    data = [(DAY, c, c, "SEARCH", 10, 0, 1.0, 0, 0.0, 0.0, 0.0, 0.0, 0.0) for c in ("a", None)]
    src = tables(google_ads_daily_performance=spark.createDataFrame(data, cols))
    row = one(platform_tools.google_campaign_performance(src))
    assert row.campaign_id == "a" and row.cpc is None and row.ctr == 0.0


def test_normalise_leaves_an_all_zero_column(spark):
    zero = spark.createDataFrame([("a", 0.0), ("b", 0.0)], "channel string, v double")
    assert rows(normalise_attribution(zero, "v")) == {("a", 0.0), ("b", 0.0)}
    assert {r.share_pct for r in share_of_total(zero, "v").collect()} == {None}
    third = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "channel string, v double")
    assert rows(normalise_attribution(third, "v")) == {("a", 33.3), ("b", 66.7)}


def test_merge_keeps_unmatched_and_null_keys(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, x int")
    right = spark.createDataFrame([(None, 3), ("b", 4)], "k string, y int")
    assert rows(merge_on(["k"], [left, right]), "k", "x", "y") == {("a", 1, None), (None, 2, 3), ("b", None, 4)}


def test_full_join_keeps_both_sides(src):
    got = {r.channel: r for r in fct_channel_performance(src).collect()}
    assert got["google_ads"].total_orders == 0 and got["google_ads"].total_spend > 0
    assert got["typed_in"].total_spend == 0.0 and got["typed_in"].attributed_revenue > 0
    assert all(r.cac == 0.0 and r.roas == 0.0 for r in got.values())


def test_conversions_repeat_with_deal_and_opportunity_rows(spark, tables):
    orders = spark.createDataFrame([_order("a", datetime(2024, 1, 1), None)], ORDERS)
    touches = spark.createDataFrame(
        [("a", 1, 1, "direct", "ga4", DAY, DAY, 1.0, 1.0, 1.0, 1.0)],
        "order_id string, touchpoint_position int, total_touchpoints int, channel string, platform string, "
        "touchpoint_date date, order_date date, order_revenue double, first_touch_credit double, "
        "last_touch_credit double, linear_credit double",
    )
    deals = spark.createDataFrame(
        [(d, "a", "n", "closed_won", "p", 1.0, DAY, "2024-01-01", "t", "email") for d in ("d1", "d2")],
        "deal_id string, order_id string, deal_name string, deal_stage string, pipeline string, amount double, "
        "create_date date, close_date string, deal_type string, lead_source string",
    )
    opportunities = spark.createDataFrame(
        [(o, "a", "n", "Closed Won", 100, 1.0, DAY, DAY, "Web", "t", "Q1 2024") for o in ("o1", "o2", "o3")],
        "opportunity_id string, order_id string, opportunity_name string, stage string, probability int, "
        "amount double, created_date date, close_date date, lead_source string, type string, fiscal_quarter string",
    )
    src = tables(
        orders=orders, marketing_attribution=touches, hubspot_deals=deals, salesforce_opportunities=opportunities
    )
    assert rows(fct_pipeline(src)) == {("direct", 1, 2, 3, 1, 6)}
    # repeated touches, deals, opportunities and orders raise no distinct count, only the joined rows
    src = tables(
        orders=orders.union(orders), marketing_attribution=touches.union(touches), hubspot_deals=deals.union(deals),
        salesforce_opportunities=opportunities.union(opportunities),
    )
    assert rows(fct_pipeline(src)) == {("direct", 1, 2, 3, 1, 2 * 2 * 4 * 6)}


def test_touchpoints_reach_back_thirteen_days(spark):
    touches = spark.createDataFrame(
        [("c", "email", DAY), ("c", "email", DAY), ("c", "direct", DAY - timedelta(days=13)),
         ("c", "direct", DAY - timedelta(days=14)), ("c", "direct", DAY + timedelta(days=1)), ("x", "email", DAY)],
        "customer_id string, channel string, touch_date date",
    )
    orders = spark.createDataFrame([("o", "c", DAY)], "order_id string, customer_id string, order_date date")
    got = rows(build_touchpoints(touches, orders), "order_id", "channel", "touch_date", "touches")
    assert got == {("o", "email", DAY, 2), ("o", "direct", DAY - timedelta(days=13), 1)}


def test_spines(spark):
    assert date_spine(spark, DAY, DAY).count() == 1
    assert int_dates(spark).count() == 1461
    assert time_spine(spark).count() == 1096


def test_funnel_checks(spark):
    steps = spark.createDataFrame(
        [("f", 1, "a", 100), ("f", 2, "b", 50), ("f", 3, "c", 60), ("g", 1, "a", 0), ("g", 2, "b", 0)],
        "by string, step int, stage string, value long",
    )
    got = {(r.by, r.step): (r.pct_of_top, r.pct_of_previous) for r in insights.funnel_steps(steps, "by").collect()}
    assert got == {
        ("f", 1): (100.0, None), ("f", 2): (50.0, 50.0), ("f", 3): (60.0, 120.0),
        ("g", 1): (None, None), ("g", 2): (None, None),
    }
    assert rows(insights.validate_funnel(steps, "by")) == {("f", "c", 60, "b", 50)}


def test_display_formats(spark):
    money = lambda v, s="compact": value(spark, fm.fmt_money(F.lit(v), s))
    assert [money(v) for v in (99.4, 1000.0, 345_600.0, 1_250_000.0)] == ["$99", "$1.0K", "$345.6K", "$1.3M"]
    assert [money(v, "precise") for v in (99.4, 1_254_999.0)] == ["$0.1K", "$1.25M"]
    assert value(spark, fm.fmt_pct(F.lit(12.345))) == "12.3%"
    assert value(spark, fm.fmt_roas(F.lit(3.456))) == "3.46×"
    assert [value(spark, fm.fmt_count(F.lit(v))) for v in (999, 1000)] == ["999", "1.0K"]
    assert value(spark, fm.fiscal_quarter(F.lit(date(2024, 11, 5)))) == "Q4 2024"


@pytest.mark.parametrize("x, digits, want", [(1.005, 2, 1.01), (-2.5, 0, -3.0), (0.285, 2, 0.29)])
def test_half_up(spark, x, digits, want):
    assert value(spark, half_up(F.lit(x), digits)) == want


def test_range_panels_take_both_bounds(src):
    all_days = {r.order_date for r in panels.daily_revenue_range(src).collect()}
    low, high = sorted(all_days)[3], sorted(all_days)[10]
    got = {r.order_date for r in panels.daily_revenue_range(src, low, high).collect()}
    assert got == {d for d in all_days if low <= d <= high}
    orders = src.model(stg_orders).filter(F.col("order_date").between(low, high))
    assert sum(r.cnt for r in panels.review_distribution(src, low, high).collect()) <= orders.count()
    paid = panels.payment_distribution(src, low, high).agg(F.sum("cnt")).first()[0]
    want = src.table("order_payments").join(orders.select("order_id"), "order_id").count()
    assert paid == want
