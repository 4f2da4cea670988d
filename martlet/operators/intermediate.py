"""Intermediate models shared by the marts; lazy, inlined by the optimizer."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions.numeric import money_mean, money_sum
from martlet.operators.staging import (
    stg_google_ads_performance,
    stg_hubspot_deals,
    stg_marketing_attribution,
    stg_meta_ads_performance,
    stg_order_payments,
    stg_orders,
    stg_salesforce_opportunities,
)
from martlet.sources.registry import Sources


def int_campaign_unified(src: Sources) -> DataFrame:
    """Both ad platforms under one set of column names."""
    shared = ["date", "campaign_name", "impressions", "roas"]
    search = src.model(stg_google_ads_performance).select(
        *shared,
        F.lit("google_ads").alias("platform"),
        F.col("campaign_type").alias("campaign_category"),
        "clicks",
        F.col("cost").alias("spend"),
        "conversions",
        F.col("conversion_value").alias("revenue"),
    )
    social = src.model(stg_meta_ads_performance).select(
        *shared,
        F.lit("meta_ads").alias("platform"),
        F.col("objective").alias("campaign_category"),
        F.col("link_clicks").alias("clicks"),
        "spend",
        F.col("purchases").alias("conversions"),
        F.col("purchase_value").alias("revenue"),
    )
    return search.unionByName(social)


def delivered_orders(src: Sources) -> DataFrame:
    return src.model(stg_orders).filter(F.col("order_status") == "delivered")


def payment_totals(src: Sources) -> DataFrame:
    """Paid amount and one payment type (the last by name) per order."""
    return (
        src.model(stg_order_payments)
        .groupBy("order_id")
        .agg(
            money_sum("payment_value").alias("payment_total"),
            F.max("payment_type").alias("primary_payment_type"),
        )
    )


def int_customer_orders(src: Sources) -> DataFrame:
    revenue = src.model(payment_totals).select("order_id", F.col("payment_total").alias("order_revenue"))
    first, last = F.min("order_date"), F.max("order_date")
    n_orders = F.count_distinct("order_id")
    return (
        src.model(delivered_orders)
        .select("order_id", "customer_id", "order_date")
        .join(revenue, "order_id", "left")
        .groupBy("customer_id")
        .agg(
            first.alias("first_order_date"),
            last.alias("last_order_date"),
            n_orders.alias("total_orders"),
            money_sum("order_revenue").alias("total_revenue"),
            money_mean("order_revenue").alias("avg_order_value"),
            F.try_divide(F.datediff(last, first), n_orders - 1).alias("avg_days_between_orders"),
        )
    )


def customer_segment(revenue: Column, orders: Column) -> Column:
    """A customer without revenue or with a single small order is new."""
    return (
        F.when((revenue >= 500) | (orders >= 3), "vip").when(orders >= 2, "returning").otherwise("new")
    )


def int_customer_ltv(src: Sources) -> DataFrame:
    revenue, orders = F.col("total_revenue"), F.col("total_orders")
    high = F.coalesce((revenue > 200) & (orders > 1), F.lit(False))
    return src.model(int_customer_orders).select(
        "customer_id",
        "total_orders",
        "total_revenue",
        "avg_order_value",
        "first_order_date",
        "last_order_date",
        customer_segment(revenue, orders).alias("customer_segment"),
        high.cast("int").alias("is_high_value"),
    )


def first_touches(src: Sources) -> DataFrame:
    return (
        src.model(stg_marketing_attribution)
        .filter(F.col("touchpoint_position") == 1)
        .select(
            "order_id",
            F.col("channel").alias("attribution_channel"),
            F.col("platform").alias("attribution_platform"),
            "touchpoint_date",
        )
    )


def int_funnel_stages(src: Sources) -> DataFrame:
    """Each order with its first touch, its deals and its opportunities (all optional)."""
    deals = src.model(stg_hubspot_deals).select(
        "order_id",
        F.col("deal_id").alias("hubspot_deal_id"),
        F.col("create_date").alias("hubspot_create_date"),
        F.col("deal_stage").alias("hubspot_stage"),
    )
    opportunities = src.model(stg_salesforce_opportunities).select(
        "order_id",
        F.col("opportunity_id").alias("sf_opportunity_id"),
        F.col("created_date").alias("sf_created_date"),
        F.col("stage").alias("sf_stage"),
    )
    orders = src.model(stg_orders).select(
        "order_id", "customer_id", "order_date", "order_status", "order_purchase_timestamp"
    )
    return (
        orders.join(src.model(first_touches), "order_id", "left")
        .join(deals, "order_id", "left")
        .join(opportunities, "order_id", "left")
    )


def date_spine(spark: SparkSession, start: date, end: date, name: str = "date_day") -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(start), F.lit(end))
    return spark.range(1).select(F.explode(days).alias(name))


def int_dates(spark: SparkSession) -> DataFrame:
    # The default bounds, the end one day before the exclusive bound.
    return date_spine(spark, date(2016, 1, 1), date(2020, 1, 1) - timedelta(days=1))


def time_spine(spark: SparkSession, start: date = date(2024, 1, 1), end: date = date(2026, 12, 31)) -> DataFrame:
    return date_spine(spark, start, end)


def observed_spine(df: DataFrame, day: str) -> DataFrame:
    """One row per calendar day between the first and the last day of a column, gaps included."""
    return df.agg(F.min(day).alias("_lo"), F.max(day).alias("_hi")).select(
        F.explode(F.sequence("_lo", "_hi")).alias("date_day")
    )


def spine_filled(df: DataFrame, day: str, measures: dict[str, Column]) -> DataFrame:
    """Daily measures on every calendar day of the column's span, 0 on days without rows."""
    daily = df.groupBy(F.col(day).alias("date_day")).agg(*[m.alias(n) for n, m in measures.items()])
    return (
        observed_spine(df, day)
        .join(daily, "date_day", "left")
        .select("date_day", *[F.coalesce(n, F.lit(0)).alias(n) for n in measures])
    )


INTERMEDIATE = {
    fn.__name__: fn
    for fn in (int_campaign_unified, int_customer_orders, int_customer_ltv, int_funnel_stages)
}
