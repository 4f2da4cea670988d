"""Staging: one lazy projection per source, typed and lightly derived."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions.numeric import ratio
from martlet.sources.registry import Sources


def _ts(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz")


def _with_types(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in casts.items()})


def stg_orders(src: Sources) -> DataFrame:
    stamps = [
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ]
    bought, delivered = F.col(stamps[0]), F.col(stamps[3])
    late = delivered > F.col(stamps[4])
    return (
        src.table("orders")
        .select("order_id", "customer_id", "order_status", *[_ts(s).alias(s) for s in stamps])
        .filter(bought.isNotNull())
        .withColumns(
            {
                "order_date": bought.cast("date"),
                "order_year": F.year(bought),
                "order_month": F.month(bought),
                # calendar-day boundaries crossed, not whole 24-hour spans
                "delivery_days": F.datediff(delivered.cast("date"), bought.cast("date")),
                # an order that never arrived is not late
                "is_late_delivery": F.coalesce(late, F.lit(False)),
            }
        )
    )


def stg_customers(src: Sources) -> DataFrame:
    return src.table("customers").withColumn("customer_city", F.lower("customer_city"))


def stg_sellers(src: Sources) -> DataFrame:
    return src.table("sellers").withColumn("seller_city", F.lower("seller_city"))


def stg_order_items(src: Sources) -> DataFrame:
    return _cleaned_items(src.table("order_items"))


def order_lines(src: Sources) -> DataFrame:
    """``stg_order_items`` for models that don't need the number of an item in its order; it may be missing."""
    return _cleaned_items(src.unnumbered("order_items"))


def _cleaned_items(items: DataFrame) -> DataFrame:
    return (
        items
        .withColumn("total_item_value", F.col("price") + F.col("freight_value"))
        .withColumn("shipping_limit_date", _ts("shipping_limit_date"))
    )


def stg_order_payments(src: Sources) -> DataFrame:
    return src.table("order_payments").select(
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"
    )


def stg_order_reviews(src: Sources) -> DataFrame:
    return (
        src.table("order_reviews")
        .filter(F.col("review_score").isNotNull())
        .withColumns(
            {
                "review_creation_date": _ts("review_creation_date"),
                "review_answer_timestamp": _ts("review_answer_timestamp"),
                "is_positive": F.col("review_score") >= 4,
                "review_length": F.length("review_comment_message"),
            }
        )
    )


def stg_products(src: Sources) -> DataFrame:
    """Products with a category, named in English where a translation exists."""
    raw_name, english = "product_category_name", "product_category_name_english"
    volume = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    return (
        src.table("products")
        .filter(F.col(raw_name).isNotNull())
        .join(src.table("category_translation"), raw_name, "left")
        .withColumn(raw_name, F.coalesce(english, raw_name))
        .withColumn("product_volume", volume)
        .drop(english)
    )


def stg_ga4_sessions(src: Sources) -> DataFrame:
    engagement = ratio(F.col("engaged_sessions"), F.col("sessions")) * 100
    return _with_types(src.table("ga4_daily_sessions"), {"date": "date"}).withColumn(
        "engagement_rate", engagement
    )


def stg_google_ads_performance(src: Sources) -> DataFrame:
    return _with_types(src.table("google_ads_daily_performance"), {"date": "date"})


def stg_meta_ads_performance(src: Sources) -> DataFrame:
    return _with_types(src.table("meta_ads_daily_performance"), {"date": "date"})


def stg_hubspot_contacts(src: Sources) -> DataFrame:
    days = ("create_date", "first_order_date", "last_activity_date")
    return _with_types(src.table("hubspot_contacts"), dict.fromkeys(days, "date"))


def stg_hubspot_deals(src: Sources) -> DataFrame:
    """An open deal has an empty close date, which becomes NULL before the cast."""
    return src.table("hubspot_deals").withColumns(
        {
            "create_date": F.col("create_date").cast("date"),
            "close_date": F.nullif(F.col("close_date"), F.lit("")).cast("date"),
            "is_closed_won": F.coalesce(F.col("deal_stage") == "closed_won", F.lit(False)),
        }
    )


def stg_salesforce_opportunities(src: Sources) -> DataFrame:
    return src.table("salesforce_opportunities").withColumns(
        {
            "created_date": F.col("created_date").cast("date"),
            "close_date": F.col("close_date").cast("date"),
            "is_won": F.coalesce(F.col("stage") == "Closed Won", F.lit(False)),
            "weighted_amount": F.col("amount") * F.col("probability") / 100,
        }
    )


def stg_marketing_attribution(src: Sources) -> DataFrame:
    days = ("touchpoint_date", "order_date")
    return _with_types(src.table("marketing_attribution"), dict.fromkeys(days, "date"))


STAGING = {
    fn.__name__: fn
    for fn in (
        stg_orders, stg_customers, stg_sellers, stg_order_items, stg_order_payments,
        stg_order_reviews, stg_products, stg_ga4_sessions, stg_google_ads_performance,
        stg_meta_ads_performance, stg_hubspot_contacts, stg_hubspot_deals,
        stg_salesforce_opportunities, stg_marketing_attribution,
    )
}
