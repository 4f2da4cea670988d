"""Marts: facts and dimensions.

Every side is aggregated to the join key before it is joined. The sides of ``fct_orders`` share
the order key, so their shuffles line up and the joins add none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions.metrics import time_decay_credit
from martlet.functions.numeric import count_if, money_mean, money_sum, ratio, zero_if_null
from martlet.operators.intermediate import (
    delivered_orders,
    first_touches,
    int_campaign_unified,
    int_customer_ltv,
    payment_totals,
)
from martlet.operators.staging import (
    stg_customers,
    stg_ga4_sessions,
    stg_google_ads_performance,
    stg_hubspot_contacts,
    stg_hubspot_deals,
    stg_marketing_attribution,
    stg_meta_ads_performance,
    order_lines,
    stg_order_reviews,
    stg_orders,
    stg_products,
    stg_salesforce_opportunities,
)
from martlet.sources.io import write_table
from martlet.sources.registry import Sources


def _item_totals(src: Sources) -> DataFrame:
    return (
        src.model(order_lines)
        .groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("item_count"),
            money_sum("price").alias("items_total"),
            money_sum("freight_value").alias("freight_total"),
        )
    )


def _review_summary(src: Sources) -> DataFrame:
    return (
        src.model(stg_order_reviews)
        .groupBy("order_id")
        .agg(
            F.max("review_score").alias("review_score"),
            F.max((F.col("review_score") >= 4).cast("int")).alias("positive_review"),
        )
    )


def _orders_with_touches(src: Sources, touches: DataFrame) -> DataFrame:
    people = src.model(stg_customers).select("customer_id", "customer_city", "customer_state")
    return (
        src.model(delivered_orders)
        .join(_item_totals(src), "order_id", "left")
        .join(src.model(payment_totals), "order_id", "left")
        .join(_review_summary(src), "order_id", "left")
        .join(touches, "order_id", "left")
        .join(people, "customer_id", "left")
        .select(
            "order_id", "customer_id", "order_date", "order_year", "order_month", "order_status",
            "delivery_days", "is_late_delivery", "item_count", "items_total", "freight_total",
            F.coalesce("payment_total", F.lit(0.0)).alias("revenue"),
            "primary_payment_type", "review_score", "positive_review", "customer_city",
            "customer_state", "first_touch_channel", "last_touch_channel", "touchpoint_count",
        )
    )


def fct_orders(src: Sources) -> DataFrame:
    """Delivered orders with items, payments, review, customer and touch channels.

    First and last channel are the first and last by name, as the model defines them.
    """
    touches = (
        src.model(stg_marketing_attribution)
        .groupBy("order_id")
        .agg(
            F.min("channel").alias("first_touch_channel"),
            F.max("channel").alias("last_touch_channel"),
            F.count(F.lit(1)).alias("touchpoint_count"),
        )
    )
    return _orders_with_touches(src, touches)


def fct_orders_positional(src: Sources) -> DataFrame:
    """``fct_orders`` with the first and last channel by touch position."""
    touches = (
        src.model(stg_marketing_attribution)
        .groupBy("order_id")
        .agg(
            F.min_by("channel", "touchpoint_position").alias("first_touch_channel"),
            F.max_by("channel", "touchpoint_position").alias("last_touch_channel"),
            F.count(F.lit(1)).alias("touchpoint_count"),
        )
    )
    return _orders_with_touches(src, touches)


def order_revenue(src: Sources) -> DataFrame:
    """The rows of ``fct_orders`` with the columns that need no items, reviews or touches.

    Reads the stored fact if it was built; otherwise joins the payments only, since the other
    sides of the fact are keyed one to one and change no row.
    """
    columns = [
        "order_id", "customer_id", "order_date", "order_status", "delivery_days",
        "is_late_delivery", "revenue", "primary_payment_type",
    ]
    if "fct_orders" in src.stored:
        return src.model(fct_orders).select(*columns)
    return (
        src.model(delivered_orders)
        .join(src.model(payment_totals), "order_id", "left")
        .withColumn("revenue", F.coalesce("payment_total", F.lit(0.0)))
        .select(*columns)
    )


def fct_daily_revenue(src: Sources) -> DataFrame:
    """Per day: orders, revenue, mean order value, customers and first-time customers.

    The orders are folded to (customer, day) first, and a customer's first day is a minimum over
    the folded days, so no customer's rows meet in a window.
    """
    per_customer = (
        src.model(order_revenue)
        .groupBy("order_date", "customer_id")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.sum("revenue").alias("revenue"),
            F.count("revenue").alias("paid"),
        )
    )
    daily = per_customer.groupBy("order_date").agg(
        F.sum("orders").alias("order_count"),
        money_sum("revenue").alias("total_revenue"),
        F.sum("paid").alias("_paid"),
        F.count("customer_id").alias("unique_customers"),
    )
    arrivals = (
        per_customer.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.min("order_date").alias("order_date"))
        .groupBy("order_date")
        .agg(F.count(F.lit(1)).alias("new_customers"))
    )
    return daily.join(arrivals, "order_date", "left").select(
        "order_date",
        "order_count",
        "total_revenue",
        F.try_divide("total_revenue", "_paid").alias("avg_order_value"),
        "unique_customers",
        zero_if_null(F.col("new_customers")).alias("new_customers"),
    )


def fct_marketing_attribution(src: Sources, half_life: float = 7.0) -> DataFrame:
    """Revenue credited to each channel by first touch, last touch, linear and time decay."""
    decay = time_decay_credit(F.col("touchpoint_date"), F.col("order_date"), half_life)
    credited = lambda credit: money_sum(credit * F.col("order_revenue"))
    return (
        src.model(stg_marketing_attribution)
        .groupBy("channel")
        .agg(
            credited(F.col("first_touch_credit")).alias("first_touch_revenue"),
            credited(F.col("last_touch_credit")).alias("last_touch_revenue"),
            credited(F.col("linear_credit")).alias("linear_revenue"),
            credited(decay).alias("time_decay_revenue"),
            F.count_distinct("order_id").alias("total_orders"),
        )
    )


def time_decay_normalised(src: Sources, half_life: float = 7.0) -> DataFrame:
    """Time-decay revenue per channel with the credits of each order scaled to sum to 1.

    The touches are folded to (order, channel) before the order's weights are summed, so the window holds one row per
    channel of an order, however many touches the order has, and the folded rows are worked out once.
    """
    decay = time_decay_credit(F.col("touchpoint_date"), F.col("order_date"), half_life)
    weighted = src.model(stg_marketing_attribution).select(
        "order_id", "channel", "order_revenue", decay.alias("_weight")
    )
    folded = weighted.groupBy("order_id", "channel").agg(
        F.sum("_weight").alias("_weight"), F.max("order_revenue").alias("order_revenue")
    )
    all_weights = F.sum("_weight").over(Window.partitionBy("order_id"))
    return (
        folded.filter(F.col("order_id").isNotNull())
        .withColumn("_all", all_weights)
        .groupBy("channel")
        .agg(
            money_sum(F.col("order_revenue") * F.col("_weight") / F.col("_all")).alias("time_decay_revenue"),
            F.count(F.lit(1)).alias("total_orders"),
        )
    )


def _channel_efficiency(spend: DataFrame, revenue: DataFrame) -> DataFrame:
    orders, cost, earned = F.col("_orders"), F.col("_spend"), F.col("_revenue")
    return (
        spend.join(revenue, "channel", "full")
        .filter(F.col("channel").isNotNull())
        .select(
            "channel",
            F.coalesce(cost, F.lit(0.0)).alias("total_spend"),
            F.coalesce(earned, F.lit(0.0)).alias("attributed_revenue"),
            zero_if_null(orders).alias("total_orders"),
            F.coalesce(ratio(cost, orders), F.lit(0.0)).alias("cac"),
            F.coalesce(ratio(earned, cost), F.lit(0.0)).alias("roas"),
        )
    )


def _spend_by_platform(src: Sources) -> DataFrame:
    return (
        src.model(int_campaign_unified)
        .groupBy(F.col("platform").alias("channel"))
        .agg(money_sum("spend").alias("_spend"))
    )


def fct_channel_performance(src: Sources) -> DataFrame:
    """Spend by platform against linear revenue by channel; unmatched names stay on their own row."""
    revenue = src.model(fct_marketing_attribution).select(
        "channel", F.col("linear_revenue").alias("_revenue"), F.col("total_orders").alias("_orders")
    )
    return _channel_efficiency(_spend_by_platform(src), revenue)


def channel_performance_by_platform(src: Sources) -> DataFrame:
    """The same, with revenue and orders also taken by platform, so that spend finds its revenue."""
    revenue = (
        src.model(stg_marketing_attribution)
        .groupBy(F.col("platform").alias("channel"))
        .agg(
            money_sum(F.col("linear_credit") * F.col("order_revenue")).alias("_revenue"),
            F.count_distinct("order_id").alias("_orders"),
        )
    )
    return _channel_efficiency(_spend_by_platform(src), revenue)


def fct_marketing_daily(src: Sources) -> DataFrame:
    """Days with ads: spend by platform, conversions, sessions and the cost ratios."""
    spend_of = lambda p: money_sum(F.when(F.col("platform") == p, F.col("spend")).otherwise(0.0))
    ads = (
        src.model(int_campaign_unified)
        .groupBy("date")
        .agg(
            spend_of("google_ads").alias("google"),
            spend_of("meta_ads").alias("meta"),
            money_sum("spend").alias("spend"),
            F.sum("conversions").alias("conversions"),
        )
    )
    visits = src.model(stg_ga4_sessions).groupBy("date").agg(F.sum("sessions").alias("visits"))
    or_zero = lambda c: F.coalesce(c, F.lit(0.0))
    spend = F.col("spend")
    # Every ad day is a group of ``ads``, so the list of distinct days needs no scan of its own.
    return ads.join(visits, "date", "left").select(
        "date",
        or_zero(F.col("google")).alias("total_google_spend"),
        or_zero(F.col("meta")).alias("total_meta_spend"),
        or_zero(spend).alias("total_spend"),
        zero_if_null(F.col("conversions")).alias("total_conversions"),
        zero_if_null(F.col("visits")).alias("ga4_total_sessions"),
        or_zero(ratio(spend, F.col("conversions"))).alias("blended_cac"),
        or_zero(ratio(spend, F.col("visits"))).alias("cost_per_session"),
    )


def fct_pipeline(src: Sources) -> DataFrame:
    """Per first-touch channel: orders, deals, opportunities, won orders and conversions.

    Orders, touches, deals and opportunities are folded to the order first, with their distinct
    ids and row counts, so a repeated row raises no distinct count and no row is expanded once per
    distinct column. A deal and an opportunity belong to one order. ``total_conversions`` counts
    the delivered rows of the plain join: the product of the row counts.
    """
    deals = (
        src.model(stg_hubspot_deals)
        .groupBy("order_id")
        .agg(F.count_distinct("deal_id").alias("deals"), F.count(F.lit(1)).alias("deal_rows"))
    )
    opportunities = (
        src.model(stg_salesforce_opportunities)
        .groupBy("order_id")
        .agg(F.count_distinct("opportunity_id").alias("opps"), F.count(F.lit(1)).alias("opp_rows"))
    )
    won = F.col("order_status") == "delivered"
    orders = src.model(stg_orders).groupBy("order_id").agg(count_if(won).alias("won_rows"))
    touched = (
        src.model(first_touches)
        .filter(F.col("attribution_channel").isNotNull())
        .groupBy("order_id", "attribution_channel")
        .agg(F.count(F.lit(1)).alias("touch_rows"))
    )
    pairs = F.col("touch_rows") * F.coalesce("deal_rows", F.lit(1)) * F.coalesce("opp_rows", F.lit(1))
    return (
        orders.join(touched, "order_id")
        .join(deals, "order_id", "left")
        .join(opportunities, "order_id", "left")
        .groupBy("attribution_channel")
        .agg(
            F.count(F.lit(1)).alias("total_touches"),
            zero_if_null(F.sum("deals")).alias("total_leads"),
            zero_if_null(F.sum("opps")).alias("total_opportunities"),
            count_if(F.col("won_rows") > 0).alias("closed_won"),
            F.sum(F.col("won_rows") * pairs).alias("total_conversions"),
        )
    )


def fct_lead_scoring_features(src: Sources) -> DataFrame:
    leads = (
        src.model(stg_hubspot_contacts)
        .groupBy(F.col("customer_id").alias("customer_unique_id"))
        .agg(F.min("lead_source").alias("lead_source"))
    )
    people = src.model(stg_customers).select("customer_id", "customer_unique_id", "customer_state")
    return (
        src.model(int_customer_ltv)
        .join(people, "customer_id")
        .join(leads, "customer_unique_id", "left")
        .select(
            "customer_id", "lead_source", "total_orders", "total_revenue", "avg_order_value",
            "customer_segment", "customer_state", "is_high_value",
        )
    )


def dim_customers(src: Sources) -> DataFrame:
    contacts = src.model(stg_hubspot_contacts).select(
        F.col("customer_id").alias("customer_unique_id"),
        "email",
        "first_name",
        "last_name",
        "lead_source",
        F.col("create_date").alias("lead_create_date"),
    )
    return (
        src.model(stg_customers)
        .join(src.model(int_customer_ltv), "customer_id", "left")
        .join(contacts, "customer_unique_id", "left")
        .select(
            "customer_id", "customer_unique_id", "email", "first_name", "last_name",
            "customer_city", "customer_state", "lead_source", "lead_create_date", "total_orders",
            "total_revenue", "avg_order_value", "customer_segment", "is_high_value",
        )
    )


def dim_products(src: Sources) -> DataFrame:
    """Products with units sold, revenue, mean price and the mean score of their orders' reviews."""
    items = src.model(order_lines)
    sales = items.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("total_units_sold"),
        money_sum("price").alias("total_revenue"),
        money_mean("price").alias("avg_price"),
    )
    scores = (
        src.model(stg_order_reviews)
        .select("order_id", "review_score")
        .join(items.select("order_id", "product_id"), "order_id")
        .groupBy("product_id")
        .agg(F.avg("review_score").alias("avg_review_score"))
    )
    zero = {"total_units_sold": 0, "total_revenue": 0.0, "avg_price": 0.0, "avg_review_score": 0.0}
    return (
        src.model(stg_products)
        .join(sales, "product_id", "left")
        .join(scores, "product_id", "left")
        .fillna(zero)
    )


def dim_campaigns(src: Sources) -> DataFrame:
    def campaigns(ads: DataFrame, platform: str, category: str) -> DataFrame:
        return ads.select(
            "campaign_id",
            "campaign_name",
            F.lit(platform).alias("platform"),
            F.col(category).alias("campaign_category"),
        ).distinct()

    return campaigns(src.model(stg_google_ads_performance), "google_ads", "campaign_type").unionByName(
        campaigns(src.model(stg_meta_ads_performance), "meta_ads", "objective")
    )


# Facts that others read come first.
MARTS = {
    fn.__name__: fn
    for fn in (
        fct_orders, fct_daily_revenue, fct_marketing_attribution, fct_channel_performance,
        fct_marketing_daily, fct_pipeline, fct_lead_scoring_features, dim_customers, dim_products,
        dim_campaigns,
    )
}


def build_marts(src: Sources, folder: str, names: list[str] | None = None) -> Sources:
    """Full refresh of the marts as parquet; later marts and queries then read the stored ones."""
    for name in names or list(MARTS):
        src.stored[name] = write_table(src.model(MARTS[name]), f"{folder.rstrip('/')}/{name}")
    return src
