"""Dashboard panels. ``start`` and ``end`` bound the panel's dates, both included."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions.frames import last_points, merge_on, share_of_total, top_k, union_all
from martlet.functions.numeric import (
    count_if,
    guarded,
    half_up,
    in_range,
    mean,
    money_mean,
    money_sum,
    ratio,
    week,
)
from martlet.operators.marts import (
    fct_daily_revenue,
    fct_lead_scoring_features,
    fct_marketing_attribution,
    fct_marketing_daily,
    fct_orders,
    fct_pipeline,
    order_revenue,
)
from martlet.operators.staging import (
    stg_customers,
    stg_ga4_sessions,
    stg_google_ads_performance,
    stg_hubspot_deals,
    stg_meta_ads_performance,
    order_lines,
    stg_order_payments,
    stg_order_reviews,
    stg_orders,
    stg_products,
    stg_salesforce_opportunities,
)
from martlet.sources.registry import Sources


def _sums(*names: str) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def _rows() -> Column:
    return F.count(F.lit(1))


def _orders_between(src: Sources, start, end) -> DataFrame:
    """Orders of the range; the bounds are set on the stored timestamp so the scan can skip files."""
    bought = F.col("order_purchase_timestamp")
    orders = src.model(stg_orders)
    if start is not None:
        orders = orders.filter(bought >= F.lit(str(start)).cast("timestamp_ntz"))
    if end is not None:
        after = date.fromisoformat(str(end)[:10]) + timedelta(days=1)
        orders = orders.filter(bought < F.lit(str(after)).cast("timestamp_ntz"))
    return orders


# Revenue and orders


def daily_revenue_range(src: Sources, start=None, end=None) -> DataFrame:
    return (
        src.model(fct_daily_revenue)
        .filter(in_range("order_date", start, end))
        .select("order_date", "order_count", "total_revenue", "avg_order_value", "unique_customers")
    )


def weekly_revenue(src: Sources, start=None, end=None) -> DataFrame:
    return (
        daily_revenue_range(src, start, end)
        .groupBy(week("order_date").alias("week"))
        .agg(
            money_sum("total_revenue").alias("total_revenue"),
            F.sum("order_count").alias("order_count"),
            mean("avg_order_value").alias("avg_aov"),
        )
    )


def weekly_aov(src: Sources, start=None, end=None) -> DataFrame:
    return (
        daily_revenue_range(src, start, end)
        .groupBy(week("order_date").alias("week"))
        .agg(mean("avg_order_value").alias("aov"))
    )


def top_categories(src: Sources, start=None, end=None, n: int = 15) -> DataFrame:
    """Product categories by revenue of delivered orders.

    Only delivered lines meet the products, and one fold to (category, order) does for the sum and the distinct orders. A fold to
    (order, product) before the join would hold about as many groups as there are lines.
    """
    delivered = _orders_between(src, start, end).filter(F.col("order_status") == "delivered")
    by_order = (
        src.model(order_lines)
        .join(delivered.select("order_id"), "order_id")
        .join(src.model(stg_products).select("product_id", F.col("product_category_name").alias("category")), "product_id")
        .groupBy("category", "order_id")
        .agg(F.sum("price").alias("price"))
    )
    by_category = by_order.groupBy("category").agg(money_sum("price").alias("revenue"), _rows().alias("orders"))
    return top_k(by_category, n, F.col("revenue").desc(), F.col("category").asc())


def revenue_by_state(src: Sources, start=None, end=None) -> DataFrame:
    """Revenue is summed per customer first; the customer join then sees one row each."""
    per_customer = (
        src.model(order_revenue)
        .filter(in_range("order_date", start, end))
        .groupBy("customer_id")
        .agg(F.sum("revenue").alias("revenue"), F.count_distinct("order_id").alias("orders"))
    )
    return (
        per_customer.join(src.model(stg_customers).select("customer_id", "customer_state"), "customer_id", "left")
        .groupBy(F.col("customer_state").alias("state"))
        .agg(money_sum("revenue").alias("revenue"), F.sum("orders").alias("orders"))
    )


def payment_distribution(src: Sources, start=None, end=None) -> DataFrame:
    return (
        src.model(stg_order_payments)
        .join(_orders_between(src, start, end).select("order_id"), "order_id")
        .groupBy("payment_type")
        .agg(_rows().alias("cnt"), money_sum("payment_value").alias("total"))
    )


def review_distribution(src: Sources, start=None, end=None) -> DataFrame:
    return (
        src.model(stg_order_reviews)
        .select("order_id", "review_score")
        .join(_orders_between(src, start, end).select("order_id"), "order_id")
        .groupBy("review_score")
        .agg(_rows().alias("cnt"))
    )


def delivery_stats(src: Sources, start=None, end=None) -> DataFrame:
    """Mean delivery days and the late share of delivered orders, one row.

    The columns come from the orders alone; no side of the order fact is joined for them.
    """
    orders = (
        src.model(fct_orders).filter(in_range("order_date", start, end))
        if "fct_orders" in src.stored
        else _orders_between(src, start, end).filter(F.col("order_status") == "delivered")
    )
    late = count_if(F.col("is_late_delivery"))
    return orders.agg(
        F.avg("delivery_days").alias("avg_days"), ratio(late * F.lit(100.0), _rows()).alias("late_pct")
    )


# Spend and traffic


def weekly_spend(src: Sources, start=None, end=None) -> DataFrame:
    return (
        src.model(fct_marketing_daily)
        .filter(in_range("date", start, end))
        .groupBy(week("date").alias("week"))
        .agg(
            money_sum("total_google_spend").alias("google_spend"),
            money_sum("total_meta_spend").alias("meta_spend"),
            money_sum("total_spend").alias("total_spend"),
        )
    )


def _visits(src: Sources, start, end) -> DataFrame:
    return src.model(stg_ga4_sessions).filter(in_range("date", start, end))


def ga4_channel_summary(src: Sources, start=None, end=None) -> DataFrame:
    return (
        _visits(src, start, end)
        .groupBy("channel_group")
        .agg(
            *_sums("sessions", "new_users", "engaged_sessions"),
            mean("bounce_rate").alias("avg_bounce_rate"),
            mean("avg_session_duration_sec").alias("avg_duration"),
            mean("pages_per_session").alias("avg_pages"),
            mean("engagement_rate").alias("engagement_rate"),
        )
    )


def ga4_weekly_by_channel(src: Sources, start=None, end=None) -> DataFrame:
    return (
        _visits(src, start, end)
        .groupBy(week("date").alias("week"), "channel_group")
        .agg(*_sums("sessions"))
    )


def ga4_weekly_totals(src: Sources, start=None, end=None) -> DataFrame:
    return (
        _visits(src, start, end)
        .groupBy(week("date").alias("week"))
        .agg(
            *_sums("sessions", "new_users", "engaged_sessions"),
            mean("engagement_rate").alias("engagement_rate"),
        )
    )


def ga4_by_device(src: Sources, start=None, end=None) -> DataFrame:
    return (
        _visits(src, start, end)
        .groupBy("device_category")
        .agg(*_sums("sessions", "engaged_sessions"))
    )


def sessions_pivot(src: Sources, channels: list[str], start=None, end=None) -> DataFrame:
    """Weeks as rows, the listed channels as columns, 0 where a channel has no row."""
    return (
        ga4_weekly_by_channel(src, start, end)
        .groupBy("week")
        .pivot("channel_group", channels)
        .agg(F.sum("sessions"))
        .na.fill(0)
    )


def engagement_by_channel(src: Sources, start=None, end=None) -> DataFrame:
    """Engagement as a ratio of sums, duration in minutes."""
    return ga4_channel_summary(src, start, end).select(
        "channel_group", "sessions", "new_users", "engaged_sessions",
        ratio(F.col("engaged_sessions") * F.lit(100.0), F.col("sessions")).alias("engagement_rate"),
        half_up(F.col("avg_duration") / 60, 6).alias("avg_duration_min"),
        "avg_pages",
    )


# Campaigns


def _google(src: Sources, start, end) -> DataFrame:
    return src.model(stg_google_ads_performance).filter(in_range("date", start, end))


def _meta(src: Sources, start, end) -> DataFrame:
    return src.model(stg_meta_ads_performance).filter(in_range("date", start, end))


def _roas(value: str, cost: str) -> Column:
    return guarded(money_sum(value), money_sum(cost))


def google_perf(src: Sources, start=None, end=None) -> DataFrame:
    """``avg_ctr`` multiplies a rate that is already in percent by 100; ``avg_ctr_pct`` does not."""
    return (
        _google(src, start, end)
        .groupBy("campaign_name", "campaign_type")
        .agg(
            *_sums("impressions", "clicks"),
            money_sum("cost").alias("cost"),
            *_sums("conversions"),
            money_sum("conversion_value").alias("conversion_value"),
            (mean("ctr") * 100).alias("avg_ctr"),
            mean("ctr").alias("avg_ctr_pct"),
            mean("avg_cpc").alias("avg_cpc"),
            _roas("conversion_value", "cost").alias("roas"),
        )
    )


def meta_perf(src: Sources, start=None, end=None) -> DataFrame:
    return (
        _meta(src, start, end)
        .groupBy("campaign_name", "objective")
        .agg(
            *_sums("impressions", "reach"),
            money_sum("spend").alias("spend"),
            *_sums("link_clicks", "purchases"),
            money_sum("purchase_value").alias("purchase_value"),
            (mean("ctr") * 100).alias("avg_ctr"),
            mean("ctr").alias("avg_ctr_pct"),
            mean("cpm").alias("avg_cpm"),
            _roas("purchase_value", "spend").alias("roas"),
        )
    )


def google_weekly(src: Sources, start=None, end=None) -> DataFrame:
    return (
        _google(src, start, end)
        .groupBy(week("date").alias("week"))
        .agg(
            money_sum("cost").alias("google_spend"),
            F.sum("conversions").alias("google_conv"),
            _roas("conversion_value", "cost").alias("google_roas"),
        )
    )


def meta_weekly(src: Sources, start=None, end=None) -> DataFrame:
    return (
        _meta(src, start, end)
        .groupBy(week("date").alias("week"))
        .agg(
            money_sum("spend").alias("meta_spend"),
            F.sum("purchases").alias("meta_purch"),
            _roas("purchase_value", "spend").alias("meta_roas"),
        )
    )


def spend_by_type(src: Sources, start=None, end=None) -> DataFrame:
    """Spend by campaign type of one platform and by objective of the other."""
    search = _google(src, start, end).select(
        F.lit("google_ads").alias("platform"), F.col("campaign_type").alias("category"), F.col("cost").alias("spend")
    )
    social = _meta(src, start, end).select(
        F.lit("meta_ads").alias("platform"), F.col("objective").alias("category"), "spend"
    )
    return search.unionByName(social).groupBy("platform", "category").agg(money_sum("spend").alias("spend"))


def platform_roas(src: Sources, start=None, end=None) -> DataFrame:
    def one(ads: DataFrame, platform: str, value: str, cost: str) -> DataFrame:
        return ads.agg(_roas(value, cost).alias("roas")).select(F.lit(platform).alias("platform"), "roas")

    return union_all(
        [
            one(_google(src, start, end), "google_ads", "conversion_value", "cost"),
            one(_meta(src, start, end), "meta_ads", "purchase_value", "spend"),
        ]
    )


# Attribution and funnel


def attribution_ranked(src: Sources) -> DataFrame:
    return src.model(fct_marketing_attribution).orderBy(F.col("linear_revenue").desc(), "channel")


def top_channel(src: Sources) -> DataFrame:
    return src.model(fct_marketing_attribution).agg(
        F.max_by("channel", F.struct("linear_revenue", "channel")).alias("top_channel"),
        money_sum("linear_revenue").alias("attributed_revenue"),
        _rows().alias("channels"),
    )


def pipeline_ranked(src: Sources) -> DataFrame:
    return src.model(fct_pipeline).orderBy(F.col("total_conversions").desc(), "attribution_channel")


# Model columns and their labels.
MODEL_LABELS = {
    "first_touch_revenue": "First touch",
    "last_touch_revenue": "Last touch",
    "linear_revenue": "Linear",
    "time_decay_revenue": "Time decay",
}


def attribution_long(src: Sources) -> DataFrame:
    """One row per channel and attribution model."""
    long = src.model(fct_marketing_attribution).unpivot("channel", list(MODEL_LABELS), "_model", "revenue")
    label = F.create_map(*[F.lit(x) for kv in MODEL_LABELS.items() for x in kv])
    return long.select("channel", F.element_at(label, F.col("_model")).alias("model"), "revenue")


def linear_share(src: Sources) -> DataFrame:
    shares = src.model(fct_marketing_attribution).select("channel", "linear_revenue")
    return share_of_total(shares, "linear_revenue")


def payment_share(src: Sources, start=None, end=None) -> DataFrame:
    paid = payment_distribution(src, start, end).select("payment_type", "total")
    return share_of_total(paid, "total")


def segment_share(src: Sources) -> DataFrame:
    return share_of_total(customer_segments(src).select("customer_segment", "customers"), "customers")


def funnel_overview(src: Sources, start=None, end=None) -> DataFrame:
    """Sessions, new users, engaged sessions and orders as ordered steps."""
    visits = _visits(src, start, end).agg(*_sums("sessions", "new_users", "engaged_sessions"))
    orders = daily_revenue_range(src, start, end).agg(F.sum("order_count").alias("orders"))
    steps = ["sessions", "new_users", "engaged_sessions", "orders"]
    row = merge_on([], [visits, orders])
    entries = [
        F.struct(F.lit(i).alias("step"), F.lit(s).alias("stage"), F.coalesce(s, F.lit(0)).alias("value"))
        for i, s in enumerate(steps, 1)
    ]
    return row.select(F.inline(F.array(*entries)))


# CRM


def hubspot_stages(src: Sources) -> DataFrame:
    return (
        src.model(stg_hubspot_deals)
        .groupBy("deal_stage")
        .agg(_rows().alias("deals"), money_sum("amount").alias("pipeline_value"))
    )


def sf_stages(src: Sources) -> DataFrame:
    """``avg_probability_pct`` multiplies percent by 100 again; ``avg_probability`` is 0 to 100."""
    return (
        src.model(stg_salesforce_opportunities)
        .groupBy("stage")
        .agg(
            _rows().alias("opportunities"),
            money_sum("amount").alias("pipeline_value"),
            (F.avg("probability") * 100).alias("avg_probability_pct"),
            F.avg("probability").alias("avg_probability"),
        )
    )


def hubspot_by_source(src: Sources) -> DataFrame:
    return (
        src.model(stg_hubspot_deals)
        .groupBy("lead_source")
        .agg(_rows().alias("deals"), money_sum("amount").alias("value"))
    )


def sf_by_source(src: Sources) -> DataFrame:
    return (
        src.model(stg_salesforce_opportunities)
        .groupBy("lead_source")
        .agg(_rows().alias("opps"), money_sum("amount").alias("value"))
    )


def hubspot_weekly(src: Sources, start=None, end=None) -> DataFrame:
    return (
        src.model(stg_hubspot_deals)
        .filter(in_range("create_date", start, end))
        .groupBy(week("create_date").alias("week"))
        .agg(money_sum("amount").alias("value"))
    )


# Customers and leads


def _high_value() -> Column:
    return F.col("is_high_value") == 1


def customer_segments(src: Sources) -> DataFrame:
    return (
        src.model(fct_lead_scoring_features)
        .groupBy("customer_segment")
        .agg(
            _rows().alias("customers"),
            money_sum("total_revenue").alias("revenue"),
            mean("avg_order_value").alias("avg_aov"),
            F.avg("total_orders").alias("avg_orders"),
            count_if(_high_value()).alias("high_value_count"),
        )
    )


def lead_source_perf(src: Sources) -> DataFrame:
    return (
        src.model(fct_lead_scoring_features)
        .filter(F.col("lead_source").isNotNull())
        .groupBy("lead_source")
        .agg(
            _rows().alias("customers"),
            money_sum("total_revenue").alias("revenue"),
            money_mean("total_revenue").alias("avg_revenue"),
            ratio(count_if(_high_value()) * F.lit(100.0), _rows()).alias("high_value_pct"),
        )
    )


def revenue_bucket(revenue: Column) -> Column:
    """Six revenue ranges; an unknown revenue falls into the last one."""
    out = F.when(revenue < 100, "$0–100")
    for limit, label in ((250, "$100–250"), (500, "$250–500"), (1000, "$500–1K"), (2500, "$1K–2.5K")):
        out = out.when(revenue < limit, label)
    return out.otherwise("$2.5K+")


def revenue_histogram(src: Sources) -> DataFrame:
    revenue = F.col("total_revenue")
    return (
        src.model(fct_lead_scoring_features)
        .groupBy(revenue_bucket(revenue).alias("bucket"))
        .agg(_rows().alias("customers"), F.min(revenue).alias("_from"))
        .orderBy(F.col("_from").asc_nulls_last())
        .drop("_from")
    )


# Headline figures


def kpi_summary(src: Sources, start=None, end=None) -> DataFrame:
    """The headline figures in one row; every part is a one-row aggregate, merged without a join."""
    revenue = daily_revenue_range(src, start, end).agg(
        money_sum("total_revenue").alias("total_revenue"),
        F.sum("order_count").alias("total_orders"),
        mean("avg_order_value").alias("avg_aov"),
    )
    traffic = _visits(src, start, end).agg(
        F.sum("sessions").alias("total_sessions"),
        F.sum("new_users").alias("new_users"),
        F.sum("engaged_sessions").alias("engaged_sessions"),
    )
    search = _google(src, start, end).agg(money_sum("cost").alias("google_spend"))
    social = _meta(src, start, end).agg(money_sum("spend").alias("meta_spend"))
    amount = F.col("amount")
    deal_won, opp_won = F.col("deal_stage") == "closed_won", F.col("stage") == "Closed Won"
    deals = src.model(stg_hubspot_deals).agg(
        money_sum(F.when(~deal_won, amount)).alias("hubspot_open"),
        money_sum(F.when(deal_won, amount)).alias("hubspot_won"),
    )
    opportunities = src.model(stg_salesforce_opportunities).agg(
        money_sum(F.when(~opp_won, amount)).alias("salesforce_open"),
        money_sum(F.when(opp_won, amount)).alias("salesforce_won"),
    )
    customers = src.model(fct_lead_scoring_features).agg(
        _rows().alias("total_customers"),
        count_if(_high_value()).alias("high_value_customers"),
        money_sum("total_revenue").alias("_customer_revenue"),
    )
    merged = merge_on(
        [], [revenue, traffic, search, social, deals, opportunities, customers, delivery_stats(src, start, end)]
    )
    zero = lambda name: F.coalesce(name, F.lit(0.0))
    spend = half_up(zero("google_spend") + zero("meta_spend"), 2)
    people = F.col("total_customers")
    return merged.select(
        "total_revenue", "total_orders", "total_sessions", "new_users", "engaged_sessions",
        spend.alias("total_spend"),
        guarded(F.col("total_revenue"), spend).alias("blended_roas"),
        half_up(zero("hubspot_open") + zero("salesforce_open"), 2).alias("open_pipeline"),
        half_up(zero("hubspot_won") + zero("salesforce_won"), 2).alias("won_pipeline"),
        "avg_aov",
        F.col("avg_days").alias("avg_delivery_days"),
        "late_pct",
        "total_customers",
        "high_value_customers",
        ratio(F.col("high_value_customers") * F.lit(100.0), people).alias("high_value_pct"),
        ratio(F.col("_customer_revenue"), people).alias("avg_ltv"),
    )


def weekly_roas(src: Sources, start=None, end=None) -> DataFrame:
    """Weeks with both revenue and spend; NULL when the spend is 0."""
    revenue = weekly_revenue(src, start, end).select("week", "total_revenue")
    spend = weekly_spend(src, start, end).select("week", "total_spend")
    return revenue.join(spend, "week").withColumn("roas", ratio(F.col("total_revenue"), F.col("total_spend")))


def sparkline(df: DataFrame, day: str, value: str, n: int = 14) -> DataFrame:
    return last_points(df, day, value, n)
