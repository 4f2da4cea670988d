"""Query tools of the single platforms: campaign, traffic and CRM summaries.

A NULL group key is dropped, as pandas grouping drops it; a division by zero is NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.frames import union_all
from martlet.functions.numeric import in_range, money_sum, ratio
from martlet.operators.staging import (
    stg_ga4_sessions,
    stg_google_ads_performance,
    stg_hubspot_contacts,
    stg_hubspot_deals,
    stg_meta_ads_performance,
    stg_salesforce_opportunities,
)
from martlet.sources.registry import Sources


def _present(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropna(subset=list(keys))


def google_campaign_performance(src: Sources, start=None, end=None) -> DataFrame:
    keys = ["campaign_id", "campaign_name", "campaign_type"]
    clicks = F.col("clicks")
    return (
        _present(src.model(stg_google_ads_performance), *keys)
        .filter(in_range("date", start, end))
        .groupBy(*keys)
        .agg(
            F.sum("impressions").alias("impressions"),
            F.sum("clicks").alias("clicks"),
            money_sum("cost").alias("cost"),
            F.sum("conversions").alias("conversions"),
        )
        .withColumns(
            {
                "ctr": ratio(clicks, F.col("impressions")),
                "cpc": ratio(F.col("cost"), clicks),
                "cvr": ratio(F.col("conversions"), clicks),
            }
        )
    )


def google_list_campaigns(src: Sources) -> DataFrame:
    return src.model(stg_google_ads_performance).select("campaign_id", "campaign_name", "campaign_type").distinct()


def meta_campaign_insights(src: Sources, start=None, end=None) -> DataFrame:
    """ROAS here assumes 100 per purchase; the platform's own figure is in the daily table."""
    keys = ["campaign_id", "campaign_name", "objective"]
    spend = F.col("spend")
    return (
        _present(src.model(stg_meta_ads_performance), *keys)
        .filter(in_range("date", start, end))
        .groupBy(*keys)
        .agg(
            F.sum("impressions").alias("impressions"),
            F.sum("reach").alias("reach"),
            money_sum("spend").alias("spend"),
            F.sum("link_clicks").alias("link_clicks"),
            F.sum("purchases").alias("purchases"),
        )
        .withColumns(
            {
                "cpm": ratio(spend, F.col("impressions")) * 1000,
                "cpc": ratio(spend, F.col("link_clicks")),
                "roas": ratio(F.col("purchases") * 100, spend),
            }
        )
    )


def meta_list_campaigns(src: Sources) -> DataFrame:
    return src.model(stg_meta_ads_performance).select("campaign_id", "campaign_name", "objective").distinct()


def ga4_traffic_by_channel(src: Sources, start=None, end=None) -> DataFrame:
    sessions = F.col("sessions")
    return (
        _present(src.model(stg_ga4_sessions), "channel_group")
        .filter(in_range("date", start, end))
        .groupBy("channel_group")
        .agg(*[F.sum(c).alias(c) for c in ("sessions", "engaged_sessions", "conversions")])
        .withColumns(
            {
                "engagement_rate": ratio(F.col("engaged_sessions"), sessions),
                "conversion_rate": ratio(F.col("conversions"), sessions),
            }
        )
    )


def ga4_daily_trends(src: Sources, channel: str | None = None) -> DataFrame:
    visits = _present(src.model(stg_ga4_sessions), "date")
    if channel:
        visits = visits.filter(F.col("channel_group") == channel)
    return visits.groupBy("date").agg(*[F.sum(c).alias(c) for c in ("sessions", "conversions")])


def contacts_summary(src: Sources, cities: int = 10) -> DataFrame:
    """Long form: contacts per lifecycle stage, per top city, and in total.

    The contacts are folded to (stage, city) once; the three parts share that shuffle.
    """
    folded = src.model(stg_hubspot_contacts).groupBy("lifecycle_stage", "city").agg(
        F.count(F.lit(1)).alias("n")
    )

    def counted(kind: str, column: str) -> DataFrame:
        return (
            _present(folded, column)
            .groupBy(F.col(column).alias("key"))
            .agg(F.sum("n").alias("contacts"))
            .select(F.lit(kind).alias("kind"), "key", "contacts")
        )

    top = counted("city", "city").orderBy(F.col("contacts").desc(), F.col("key").asc()).limit(cities)
    total = folded.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("contacts")).select(
        F.lit("total").alias("kind"), F.lit("all").alias("key"), "contacts"
    )
    return union_all([counted("lifecycle_stage", "lifecycle_stage"), top, total])


def deal_pipeline_summary(src: Sources) -> DataFrame:
    return (
        _present(src.model(stg_hubspot_deals), "deal_stage")
        .groupBy("deal_stage")
        .agg(F.count("deal_id").alias("deal_count"), money_sum("amount").alias("total_value"))
    )


def search_contacts(src: Sources, query: str, n: int = 10) -> DataFrame:
    """Contacts whose email, first or last name matches the pattern (case-insensitive)."""
    pattern = query.lower()
    hit = F.lit(False)
    for name in ("email", "first_name", "last_name"):
        hit = hit | F.coalesce(F.lower(name).rlike(pattern), F.lit(False))
    return src.model(stg_hubspot_contacts).filter(hit).orderBy("contact_id").limit(n)


def opportunity_pipeline(src: Sources) -> DataFrame:
    """Per stage: opportunities and value, and the expected revenue if the source has it."""
    opportunities = _present(src.model(stg_salesforce_opportunities), "stage")
    sums = [money_sum("amount").alias("amount")]
    if "expected_revenue" in opportunities.columns:
        sums.append(money_sum("expected_revenue").alias("expected_revenue"))
    return opportunities.groupBy("stage").agg(F.count("opportunity_id").alias("opp_count"), *sums)


def revenue_by_source(src: Sources) -> DataFrame:
    return (
        _present(src.model(stg_salesforce_opportunities), "lead_source")
        .filter(F.col("stage") == "Closed Won")
        .groupBy("lead_source")
        .agg(money_sum("amount").alias("total_revenue"), F.count("opportunity_id").alias("won_count"))
    )
