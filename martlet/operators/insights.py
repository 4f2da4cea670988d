"""Analytics behind the executive, attribution, campaign, sales and traffic views.

Every window here runs over rows that are already aggregated (days, weeks, steps) and is
partitioned; none sees raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions.frames import merge_on, share_of_total, top_k, union_all
from martlet.functions.metrics import (
    ASSUMED_ORDER_VALUE,
    campaign_status,
    click_cvr,
    cvr_tier,
    google_roas,
    meta_roas,
    roas_tier,
    session_cvr,
)
from martlet.functions.numeric import count_if, half_up, money_mean, money_sum, ratio, week
from martlet.operators.intermediate import int_campaign_unified
from martlet.operators.panels import weekly_revenue, weekly_spend
from martlet.operators.platform_tools import google_campaign_performance, meta_campaign_insights
from martlet.operators.staging import (
    stg_ga4_sessions,
    stg_google_ads_performance,
    stg_hubspot_contacts,
    stg_hubspot_deals,
    stg_meta_ads_performance,
    stg_salesforce_opportunities,
)
from martlet.sources.registry import Sources


def _rows() -> Column:
    return F.count(F.lit(1))


# Traffic


def _daily_sessions(src: Sources) -> DataFrame:
    """Sessions per day as one series per channel, and one over all of them (``all``)."""
    by_channel = (
        src.model(stg_ga4_sessions).groupBy("date", "channel_group").agg(F.sum("sessions").alias("sessions"))
    )
    total = (
        by_channel.groupBy("date")
        .agg(F.sum("sessions").alias("sessions"))
        .select("date", F.lit("all").alias("channel_group"), "sessions")
    )
    return by_channel.unionByName(total)


def rolling_avg(df: DataFrame, day: str, value: str, by: str, w: int = 7) -> DataFrame:
    """Trailing mean over the last w rows of each series (fewer at its start), to the whole number."""
    trail = Window.partitionBy(by).orderBy(day).rowsBetween(-(w - 1), Window.currentRow)
    return df.withColumn("rolling_avg", half_up(F.avg(value).over(trail), 0))


def sessions_rolling_avg(src: Sources, w: int = 7) -> DataFrame:
    return rolling_avg(_daily_sessions(src), "date", "sessions", "channel_group", w)


def detect_anomalies(
    df: DataFrame, day: str, value: str, by: str, threshold: float = 0.30, w: int = 7
) -> DataFrame:
    """Points that differ from the mean of the w rows before them by more than the threshold.

    The point itself is not in the mean, and the first w points of a series are not judged.
    """
    before = Window.partitionBy(by).orderBy(day).rowsBetween(-w, -1)
    base = F.col("_mean")
    change = ratio(F.col(value) - base, base)
    return (
        df.withColumns({"_mean": F.avg(value).over(before), "_n": F.count(value).over(before)})
        .withColumn("_change", change)
        .filter((F.col("_n") == w) & (F.abs("_change") > threshold))
        .select(
            day,
            by,
            value,
            half_up(base, 0).alias("prior_avg"),
            half_up(F.col("_change"), 6).alias("pct_change"),
            F.when(F.col("_change") > 0, "spike").otherwise("drop").alias("direction"),
        )
    )


def session_anomalies(src: Sources, threshold: float = 0.30) -> DataFrame:
    return detect_anomalies(_daily_sessions(src), "date", "sessions", "channel_group", threshold)


def traffic_kpis(src: Sources) -> DataFrame:
    sessions = F.col("sessions")
    return (
        src.model(stg_ga4_sessions)
        .agg(*[F.sum(c).alias(c) for c in ("sessions", "engaged_sessions", "conversions")])
        .withColumns(
            {
                "engagement_rate": ratio(F.col("engaged_sessions") * F.lit(100.0), sessions),
                "session_cvr": session_cvr(F.col("conversions"), sessions),
            }
        )
    )


def channel_conversion_funnel(src: Sources) -> DataFrame:
    return (
        src.model(stg_ga4_sessions)
        .groupBy("channel_group")
        .agg(*[F.sum(c).alias(c) for c in ("sessions", "conversions")])
    )


def channel_cvr_tiers(src: Sources) -> DataFrame:
    cvr = session_cvr(F.col("conversions"), F.col("sessions"))
    return channel_conversion_funnel(src).withColumn("session_cvr", cvr).withColumn(
        "tier", cvr_tier(F.col("session_cvr"))
    )


def channel_share(src: Sources) -> DataFrame:
    sessions = channel_conversion_funnel(src).select(F.col("channel_group").alias("channel"), "sessions")
    return share_of_total(sessions, "sessions", digits=1).orderBy(F.col("sessions").desc(), "channel")


# Funnels


def unpivot_steps(df: DataFrame, by: str, steps: list[str]) -> DataFrame:
    """Measures side by side -> one row per step, in the given order."""
    entries = [
        F.struct(F.lit(i).alias("step"), F.lit(s).alias("stage"), F.col(s).cast("long").alias("value"))
        for i, s in enumerate(steps, 1)
    ]
    return df.select(by, F.inline(F.array(*entries)))


def funnel_steps(df: DataFrame, by: str, step: str = "step", value: str = "value") -> DataFrame:
    """Each step as a percentage of the first step and of the step before (one decimal)."""
    order = Window.partitionBy(by).orderBy(step)
    top = F.first(value).over(order)
    previous = F.lag(value).over(order)
    pct = lambda base: half_up(F.try_divide(F.col(value) * F.lit(100.0), base), 1)
    return df.withColumns({"pct_of_top": pct(top), "pct_of_previous": pct(previous)})


def validate_funnel(df: DataFrame, by: str, step: str = "step", value: str = "value") -> DataFrame:
    """Steps that are larger than the step above them."""
    order = Window.partitionBy(by).orderBy(step)
    return (
        df.withColumns({"previous_stage": F.lag("stage").over(order), "previous_value": F.lag(value).over(order)})
        .filter(F.col(value) > F.col("previous_value"))
        .select(by, "stage", value, "previous_stage", "previous_value")
    )


def traffic_funnel(src: Sources) -> DataFrame:
    """Sessions, engaged sessions and conversions per channel as steps."""
    steps = ["sessions", "engaged_sessions", "conversions"]
    by_channel = (
        src.model(stg_ga4_sessions).groupBy("channel_group").agg(*[F.sum(c).alias(c) for c in steps])
    )
    return unpivot_steps(by_channel, "channel_group", steps)


def campaign_funnel(src: Sources) -> DataFrame:
    """Impressions, clicks and conversions per campaign as steps."""
    steps = ["impressions", "clicks", "conversions"]
    by_campaign = (
        src.model(int_campaign_unified).groupBy("campaign_name").agg(*[F.sum(c).alias(c) for c in steps])
    )
    return unpivot_steps(by_campaign, "campaign_name", steps)


# Campaigns


def campaign_table(src: Sources, start=None, end=None) -> DataFrame:
    """Campaigns of both platforms with ROAS by each platform's rule, CTR and click conversion rate."""
    search = google_campaign_performance(src, start, end).select(
        "campaign_name",
        F.lit("google_ads").alias("platform"),
        F.col("cost").alias("spend"),
        "impressions",
        "clicks",
        "conversions",
        google_roas(F.col("conversions"), F.col("cost")).alias("roas"),
    )
    social = meta_campaign_insights(src, start, end).select(
        "campaign_name",
        F.lit("meta_ads").alias("platform"),
        "spend",
        "impressions",
        F.col("link_clicks").alias("clicks"),
        F.col("purchases").alias("conversions"),
        meta_roas(F.col("roas")).alias("roas"),
    )
    return search.unionByName(social).withColumns(
        {
            "ctr": ratio(F.col("clicks"), F.col("impressions")),
            "click_cvr": click_cvr(F.col("conversions"), F.col("clicks")),
        }
    )


def campaign_leaderboard(src: Sources, k: int = 10, start=None, end=None) -> DataFrame:
    best = top_k(campaign_table(src, start, end), k, F.col("roas").desc_nulls_last(), F.col("campaign_name").asc())
    return best.withColumn("tier", roas_tier(F.col("roas")))


def campaign_statuses(src: Sources, start=None, end=None) -> DataFrame:
    """Every campaign with Scale, Watch or Pause."""
    return campaign_table(src, start, end).withColumn("status", campaign_status(F.col("roas")))


def top_bottom_campaigns(src: Sources, n: int = 5, start=None, end=None) -> DataFrame:
    """The n best and the n worst campaigns by ROAS (a campaign may be in both when there are few)."""
    rows = campaign_table(src, start, end).select("campaign_name", "platform", "spend", "roas")
    roas, name = F.col("roas"), F.col("campaign_name")
    best = top_k(rows, n, roas.desc_nulls_last(), name.asc()).withColumn("side", F.lit("top"))
    worst = top_k(rows, n, roas.asc_nulls_last(), name.asc()).withColumn("side", F.lit("bottom"))
    return best.unionByName(worst)


def budget_pacing(src: Sources) -> DataFrame:
    """Spend against the daily budget times the days the campaign ran, capped at 100 percent."""

    def paced(ads: DataFrame, campaigns: DataFrame, platform: str, cost: str) -> DataFrame:
        spent = ads.groupBy("campaign_id").agg(
            money_sum(cost).alias("spent"), F.count_distinct("date").alias("active_days")
        )
        return spent.join(campaigns.select("campaign_id", "campaign_name", "daily_budget"), "campaign_id").select(
            "campaign_name",
            F.lit(platform).alias("platform"),
            "spent",
            (F.col("daily_budget") * F.col("active_days")).alias("budget"),
        )

    both = union_all(
        [
            paced(src.model(stg_google_ads_performance), src.table("google_ads_campaigns"), "google_ads", "cost"),
            paced(src.model(stg_meta_ads_performance), src.table("meta_ads_campaigns"), "meta_ads", "spend"),
        ]
    )
    pct = half_up(F.try_divide(F.col("spent") * F.lit(100.0), F.col("budget")), 0)
    return both.withColumn("pacing_pct", F.least(F.lit(100.0), pct))


def _by_platform(src: Sources, *extra: Column | str) -> DataFrame:
    return src.model(int_campaign_unified).groupBy("platform", *extra)


def channel_mix_weekly(src: Sources) -> DataFrame:
    """Each platform's share of the week's ad spend."""
    weekly = _by_platform(src, week("date").alias("week")).agg(money_sum("spend").alias("spend"))
    total = F.sum("spend").over(Window.partitionBy("week"))
    return weekly.withColumn("share_pct", half_up(F.try_divide(F.col("spend") * F.lit(100.0), total), 4))


def waterfall_by_channel(src: Sources) -> DataFrame:
    return _by_platform(src).agg(*[F.sum(c).alias(c) for c in ("impressions", "clicks", "conversions")])


def efficiency_points(src: Sources) -> DataFrame:
    """Per campaign: spend, ROAS, conversions, CTR and click conversion rate."""
    return campaign_table(src).select("campaign_name", "platform", "spend", "roas", "conversions", "ctr", "click_cvr")


def platform_comparison(src: Sources) -> DataFrame:
    """Spend, clicks, conversions and ROAS at the assumed order value, side by side."""
    conversions, spend = F.col("conversions"), F.col("spend")
    return (
        _by_platform(src)
        .agg(
            money_sum("spend").alias("spend"),
            F.sum("clicks").alias("clicks"),
            F.sum("conversions").alias("conversions"),
        )
        .withColumn("roas", google_roas(conversions, spend))
    )


def daily_spend_trend(src: Sources) -> DataFrame:
    spend_of = lambda p: F.coalesce(
        money_sum(F.when(F.col("platform") == p, F.col("spend"))), F.lit(0.0)
    )
    return (
        src.model(int_campaign_unified)
        .groupBy("date")
        .agg(spend_of("google_ads").alias("google_spend"), spend_of("meta_ads").alias("meta_spend"))
    )


# CRM

# Display stage of each CRM stage, with its place in the funnel.
STAGE_GROUPS = [
    ("Prospecting", ["prospecting", "Prospecting"]),
    ("Qualified/Analysis", ["qualified", "Qualification", "Needs Analysis"]),
    ("Presentation", ["presentation_scheduled", "Value Proposition"]),
    ("Proposal Sent", ["proposal_sent", "Proposal/Price Quote"]),
    ("Negotiation", ["negotiation", "Negotiation/Review"]),
    ("Closed Won", ["closed_won", "Closed Won"]),
    ("Closed Lost", ["closed_lost", "Closed Lost"]),
]


def normalised_stage(stage: Column) -> Column:
    names = [(raw, label) for label, raws in STAGE_GROUPS for raw in raws]
    lookup = F.create_map(*[F.lit(x) for pair in names for x in pair])
    return F.coalesce(F.try_element_at(lookup, stage), stage)


def _crm(src: Sources) -> DataFrame:
    deals = src.model(stg_hubspot_deals).select(
        F.col("deal_stage").alias("stage"),
        "amount",
        "create_date",
        "close_date",
        F.lit(None).cast("double").alias("weighted"),
    )
    opportunities = src.model(stg_salesforce_opportunities).select(
        "stage", "amount", F.col("created_date").alias("create_date"), "close_date",
        F.col("weighted_amount").alias("weighted"),
    )
    return deals.unionByName(opportunities).withColumn("stage", normalised_stage(F.col("stage")))


def crm_stage_funnel(src: Sources) -> DataFrame:
    """Deals and opportunities per display stage: count and value."""
    place = F.create_map(*[F.lit(x) for i, (label, _) in enumerate(STAGE_GROUPS, 1) for x in (label, i)])
    return (
        _crm(src)
        .groupBy("stage")
        .agg(_rows().alias("deals"), money_sum("amount").alias("value"))
        .select(F.try_element_at(place, F.col("stage")).alias("step"), "stage", "deals", "value")
    )


def _closed() -> Column:
    return F.col("stage").isin("Closed Won", "Closed Lost")


def pipeline_kpis(src: Sources) -> DataFrame:
    """Open value, mean deal size, win rate, deals in progress and weighted forecast, one row."""
    won = count_if(F.col("stage") == "Closed Won")
    amount = F.col("amount")
    return _crm(src).agg(
        money_sum(F.when(~_closed(), amount)).alias("open_value"),
        money_mean("amount").alias("avg_deal_size"),
        ratio(won * F.lit(100.0), count_if(_closed())).alias("win_rate_pct"),
        count_if(~_closed()).alias("deals_in_progress"),
        half_up(F.sum(F.when(~_closed(), F.col("weighted"))), 4).alias("forecast"),
    )


def deal_age_heatmap(src: Sources, as_of: str | None = None) -> DataFrame:
    """Share of each open stage's deals by age: 0-30, 31-60, 61-90 and over 90 days.

    Without a date, ages are taken at the latest creation date.
    """
    # one row per stage and day first: the ages then need one pass over the open deals
    daily = _crm(src).groupBy("stage", "create_date").agg(_rows().alias("n"))
    today = F.lit(as_of).cast("date") if as_of else daily.agg(F.max("create_date")).scalar()
    age = F.col("_age")
    buckets = {
        "age_0_30": age <= 30,
        "age_31_60": (age > 30) & (age <= 60),
        "age_61_90": (age > 60) & (age <= 90),
        "age_90_plus": age > 90,
    }
    counted = (
        daily.filter(~_closed())
        .withColumn("_age", F.datediff(today, F.col("create_date")))
        .groupBy("stage")
        .agg(
            F.sum("n").alias("deals"),
            *[F.sum(F.when(cond, F.col("n")).otherwise(0)).alias(b) for b, cond in buckets.items()],
        )
    )
    share = lambda b: half_up(F.try_divide(F.col(b) * F.lit(100.0), F.col("deals")), 1)
    return counted.select("stage", "deals", *[share(b).alias(b) for b in buckets])


def open_deal_ages(src: Sources) -> DataFrame:
    """(stage, age, n): open deals by age in days at the latest creation date of any deal."""
    daily = _crm(src).groupBy("stage", "create_date").agg(_rows().alias("n"))
    today = daily.agg(F.max("create_date")).scalar()
    return daily.filter(~_closed()).select("stage", F.datediff(today, F.col("create_date")).alias("age"), "n")


def pipeline_velocity_days(src: Sources, target: int = 90) -> DataFrame:
    """Mean days from creation to close, against the target, one row."""
    days = F.datediff("close_date", "create_date")
    return (
        _crm(src)
        .filter(_closed())
        .agg(F.avg(days).alias("avg_days"))
        .withColumns({"target_days": F.lit(target), "on_track": F.col("avg_days") <= target})
    )


def lifecycle_distribution(src: Sources) -> DataFrame:
    return src.model(stg_hubspot_contacts).groupBy("lifecycle_stage").agg(_rows().alias("contacts"))


# Executive


def spend_vs_revenue_weekly(src: Sources, start=None, end=None) -> DataFrame:
    """Weeks with spend, revenue or both."""
    spend = weekly_spend(src, start, end).select("week", "total_spend")
    revenue = weekly_revenue(src, start, end).select("week", "total_revenue")
    return merge_on(["week"], [spend, revenue])


def static_kpis(src: Sources) -> DataFrame:
    """Spend, sessions, conversions, deal value, leads and the estimated social ROAS, one row."""
    search = src.model(stg_google_ads_performance).agg(money_sum("cost").alias("_google"))
    social = src.model(stg_meta_ads_performance).agg(
        money_sum("spend").alias("_meta"), F.sum("purchases").alias("_purchases")
    )
    traffic = src.model(stg_ga4_sessions).agg(
        F.sum("sessions").alias("total_sessions"), F.sum("conversions").alias("conversions")
    )
    deals = src.model(stg_hubspot_deals).agg(money_sum("amount").alias("pipeline_value"), _rows().alias("leads"))
    return merge_on([], [search, social, traffic, deals]).select(
        half_up(F.col("_google") + F.col("_meta"), 2).alias("total_spend"),
        "total_sessions",
        "conversions",
        "pipeline_value",
        "leads",
        ratio(F.col("_purchases") * F.lit(ASSUMED_ORDER_VALUE), F.col("_meta")).alias("estimated_roas"),
    )


def weekly_spend_outer(src: Sources, n: int = 12) -> DataFrame:
    """The last n weeks with spend on either platform, 0 where one had none."""
    google = (
        src.model(stg_google_ads_performance).groupBy(week("date").alias("week")).agg(money_sum("cost").alias("google"))
    )
    meta = src.model(stg_meta_ads_performance).groupBy(week("date").alias("week")).agg(money_sum("spend").alias("meta"))
    return merge_on(["week"], [google, meta]).na.fill(0.0).orderBy(F.col("week").desc()).limit(n)


def attribution_summary(src: Sources) -> DataFrame:
    """Sessions, conversions, revenue and mean click price per traffic channel.

    Paid search takes its clicks from the one ad platform, paid social from the other.
    """
    traffic = (
        src.model(stg_ga4_sessions)
        .groupBy("channel_group")
        .agg(
            F.sum("sessions").alias("sessions"),
            F.sum("conversions").alias("conversions"),
            money_sum("revenue").alias("revenue"),
        )
    )
    channel = F.when(F.col("platform") == "google_ads", "paid_search").otherwise("paid_social")
    clicks = (
        _by_platform(src)
        .agg(money_sum("spend").alias("_spend"), F.sum("clicks").alias("_clicks"))
        .select(channel.alias("channel_group"), ratio(F.col("_spend"), F.col("_clicks")).alias("avg_cpc"))
    )
    return traffic.join(clicks, "channel_group", "left")


