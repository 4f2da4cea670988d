"""The catalogue: every query by name, over a registry of sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martlet.functions import metrics as fm
from martlet.functions.frames import normalise_attribution
from martlet.functions.numeric import count_if, half_up, money_sum
from martlet.operators import builders, insights, panels, platform_tools, quality, scoring
from martlet.operators.asof import asof_join
from martlet.operators.attributes import attribute_rows, typed_attributes
from martlet.operators.increments import read_mart, refresh_changed_months
from martlet.operators.integrity import check_references, table_difference
from martlet.operators.intermediate import INTERMEDIATE, int_campaign_unified, observed_spine, spine_filled
from martlet.operators.intervals import range_join
from martlet.operators.marts import (
    MARTS,
    channel_performance_by_platform,
    fct_channel_performance,
    fct_daily_revenue,
    fct_marketing_attribution,
    fct_marketing_daily,
    fct_orders_positional,
    time_decay_normalised,
)
from martlet.operators.sessions import gap_sessions
from martlet.operators.staging import (
    STAGING,
    stg_customers,
    stg_ga4_sessions,
    stg_google_ads_performance,
    stg_hubspot_deals,
    stg_marketing_attribution,
    stg_meta_ads_performance,
    stg_order_items,
    stg_order_payments,
    stg_orders,
    stg_sellers,
)
from martlet.plans.metrics import pipeline_velocity, query_metric
from martlet.session import scratch_dir
from martlet.sources import adapters, io
from martlet.sources.registry import Sources
from martlet.streaming import traffic
from martlet.streaming.routing import route_leads

Query = Callable[[Sources], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _add(**entries: Query) -> None:
    QUERIES.update(entries)


# The bounds the range panels are run with here take in every row.
FIRST, LAST = "1995-01-01", "2001-12-31"


def _ranged(panel: Callable) -> Query:
    return lambda src: panel(src, FIRST, LAST)


# Models

QUERIES.update(STAGING)
QUERIES.update(INTERMEDIATE)
QUERIES.update(MARTS)
_add(
    fct_orders_positional=fct_orders_positional,
    time_decay_normalised=time_decay_normalised,
    channel_performance_by_platform=channel_performance_by_platform,
    int_dates=lambda src: observed_spine(src.model(stg_orders), "order_date"),
    time_spine=lambda src: spine_filled(
        src.model(stg_ga4_sessions),
        "date",
        {"sessions": F.sum("sessions"), "conversions": F.sum("conversions")},
    ),
)


@query
def time_decay_credit(src: Sources) -> DataFrame:
    credit = fm.time_decay_credit(F.col("touchpoint_date"), F.col("order_date"))
    return src.model(stg_marketing_attribution).select(
        "order_id", "touchpoint_position", half_up(credit, 8).alias("credit")
    )


# Sources and sinks


@query
def read_csv_table(src: Sources) -> DataFrame:
    payments = src.table("order_payments")
    folder = scratch_dir(src.spark, "csv")
    payments.write.option("header", True).csv(folder)
    return io.read_csv_table(src.spark, folder, payments.schema)


@query
def write_table(src: Sources) -> DataFrame:
    return io.write_table(src.model(fct_marketing_daily), scratch_dir(src.spark, "table"))


@query
def append(src: Sources) -> DataFrame:
    folder = scratch_dir(src.spark, "append")
    ads = src.model(int_campaign_unified)
    io.write_table(ads.filter(F.col("platform") == "google_ads"), folder)
    return io.append(ads.filter(F.col("platform") == "meta_ads"), folder)


@query
def upsert(src: Sources) -> DataFrame:
    """Customers of one region move twice (the later move wins), and sellers come in as new rows."""
    people = src.model(stg_customers)
    moved = people.filter(F.col("customer_state") == "ASIA").withColumn(
        "version", F.explode(F.array(F.lit(1), F.lit(2)))
    ).withColumn("customer_city", F.concat_ws("_", "customer_city", F.col("version").cast("string")))
    new = src.model(stg_sellers).select(
        (-1 - F.col("seller_id")).alias("customer_id"),
        F.concat(F.lit("S"), F.col("seller_id").cast("string")).alias("customer_unique_id"),
        F.col("seller_zip_code_prefix").alias("customer_zip_code_prefix"),
        F.col("seller_city").alias("customer_city"),
        F.col("seller_state").alias("customer_state"),
        F.lit(1).alias("version"),
    )
    return io.upsert(people, moved.unionByName(new), ["customer_id"], ["version"])


@query
def null_clean(src: Sources) -> DataFrame:
    """Event values with the failed ones marked NaN by the feed."""
    events = src.table("web_events").select(
        "event_id", F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")).alias("value")
    )
    return io.null_clean(events)


def _raw(src: Sources, *names: str) -> dict[str, DataFrame]:
    return {n: src.table(n) for n in names}


SOURCE_TABLES = [n for n in adapters.ADAPTERS if n not in ("web_events", "web_hits")]

_add(
    read_source=lambda src: src.table("customers"),
    load_report=lambda src: io.load_report(_raw(src, *SOURCE_TABLES)),
    describe_tables=lambda src: io.describe_tables(
        _raw(src, "orders", "customers", "order_payments", "ga4_daily_sessions")
    ),
    limit_rows=lambda src: io.limit_rows(
        src.table("orders"), 1_000, [F.col("order_purchase_timestamp").asc_nulls_last(), F.col("order_id").asc()]
    ),
    preview=lambda src: io.preview(src.model(fct_daily_revenue), 25, [F.col("order_date").asc_nulls_last()]),
)


@query
def run_sql(src: Sources) -> DataFrame:
    statement = """
        SELECT customer_state, COUNT(*) AS customers, COUNT(DISTINCT customer_city) AS cities
        FROM stg_customers GROUP BY customer_state"""
    df, error = io.run_sql(src.spark, statement, {"stg_customers": src.model(stg_customers)})
    if error:
        raise RuntimeError(error)
    return df


# Metrics


def _metric(*names: str, **how) -> Query:
    return lambda src: query_metric(src, list(names), **how)


_add(
    metric_total_revenue=_metric("total_revenue", grain="month"),
    metric_total_spend=_metric("total_spend", grain="week"),
    metric_total_sessions=_metric("total_sessions", group_by=["channel_group"]),
    metric_total_clicks=_metric("total_clicks", group_by=["platform"], grain="day"),
    metric_total_new_users=_metric("total_new_users", grain="week"),
    metric_total_engaged_sessions=_metric("total_engaged_sessions", group_by=["device_category"]),
    metric_total_orders=_metric("total_orders", group_by=["primary_payment_type"], grain="month"),
    metric_average_order_value=_metric("average_order_value", group_by=["last_touch_channel"]),
    metric_pipeline_value=_metric("total_pipeline_value", group_by=["source", "stage"]),
    metric_total_deals=_metric("total_deals", group_by=["source"], grain="year"),
    metric_channel_spend=_metric("channel_spend", group_by=["channel"]),
    metric_channel_revenue=_metric("channel_revenue", group_by=["channel"]),
    metric_channel_orders=_metric("channel_orders", group_by=["channel"]),
    metric_blended_roas=_metric("total_revenue", "total_spend", "blended_roas", grain="week"),
    metric_channel_roas=_metric("channel_roas", group_by=["channel"]),
    metric_customer_acquisition_cost=_metric("customer_acquisition_cost", group_by=["channel"]),
    metric_cost_per_session=_metric("cost_per_session", grain="day"),
    metric_engagement_rate=_metric("engagement_rate", group_by=["channel_group"], grain="week"),
    metric_session_conversion_rate=_metric("session_conversion_rate", grain="week"),
    metric_conversions=_metric("ga4_conversions", "ad_conversions", grain="day"),
    metric_win_rate=_metric("win_rate", group_by=["source"]),
    metric_velocity=pipeline_velocity,
    metric_blended_cac=_metric("total_spend", "new_customers", "blended_cac"),
    query_metric_overall=_metric("total_revenue", "total_orders", "average_order_value", "total_sessions", "blended_roas"),
    query_metric_where=_metric(
        "total_sessions", "engagement_rate", group_by=["channel_group"], grain="month",
        start=FIRST, end=LAST, where="device_category <> 'tablet'",
    ),
    metric_subtotals=_metric(
        "total_sessions", "engagement_rate", group_by=["channel_group", "device_category"], grain="month", totals=True
    ),
    metric_cube=_metric("total_deals", "total_pipeline_value", "win_rate", group_by=["source", "stage", "lead_source"], totals="cube"),
)

# Time: as-of joins, sessions, windows

SESSION_GAP = "6 hours"


@query
def deal_stage_at_touch(src: Sources) -> DataFrame:
    """Each web event with the deal that was its customer's latest by then, and the deal's stage."""
    deals = (
        src.model(stg_hubspot_deals)
        .select("deal_id", "deal_stage", "order_id")
        .join(src.model(stg_orders).select("order_id", "customer_id", "order_purchase_timestamp"), "order_id")
        .join(src.model(stg_customers).select("customer_id", F.col("customer_unique_id").alias("person")), "customer_id")
        .select(F.col("person").alias("customer_id"), F.col("order_purchase_timestamp").alias("at"), "deal_id", "deal_stage")
    )
    touches = src.table("web_hits").select("event_id", "customer_id", "ts")
    return asof_join(touches, deals, ["customer_id"], "ts", "at", ["deal_id", "deal_stage"], "month")


@query
def touch_sessions(src: Sources) -> DataFrame:
    """Sessions of each customer's web events."""
    clicks = F.when(F.col("event_type") == "click", 1).otherwise(0)
    return gap_sessions(src.table("web_hits"), "customer_id", "ts", SESSION_GAP, {"clicks": clicks})


def _arriving(src: Sources, inbox: str, late_every: int | None) -> None:
    """The web events as files in the order in which they arrive; one in ``late_every`` comes three hours late."""
    soon = F.make_dt_interval(secs=F.col("event_id") % 60)
    arrived = F.col("ts") + soon
    if late_every:
        arrived = F.when(F.col("event_id") % late_every == 0, F.col("ts") + F.expr("INTERVAL 3 HOURS")).otherwise(arrived)
    hits = src.table("web_hits").drop("props").withColumn("arrived", arrived)
    # the bounds of the files are single figures
    ends = hits.agg(F.percentile_approx(F.col("arrived").cast("double"), [0.3, 0.6]).alias("p")).first().p
    for low, high in zip([None, *(ends or [])], [*(ends or []), None]):
        at = F.col("arrived").cast("double")
        part = hits if low is None else hits.filter(at > low)
        (part if high is None else part.filter(at <= high)).write.mode("append").parquet(inbox)


def _windows(src: Sources) -> tuple[DataFrame, DataFrame]:
    base = scratch_dir(src.spark, "traffic")
    _arriving(src, f"{base}/inbox", 50)
    return traffic.run_window_metrics(
        src.spark, f"{base}/inbox", f"{base}/windows", f"{base}/late", f"{base}/checkpoint", "2 hours", "1 hour", files_per_trigger=4
    )


@query
def traffic_windows_stream(src: Sources) -> DataFrame:
    """Sliding windows of the events that came in time, by a stream over files in order of arrival."""
    return _windows(src)[0]


@query
def late_events_stream(src: Sources) -> DataFrame:
    """The events that the same stream sets apart, by channel."""
    return _windows(src)[1].groupBy("channel").agg(F.count(F.lit(1)).alias("late_events"))


@query
def touch_sessions_stream(src: Sources) -> DataFrame:
    """The sessions of ``touch_sessions`` by a stream; a row without customer, years later, closes the last ones."""
    base = scratch_dir(src.spark, "sessions")
    _arriving(src, f"{base}/inbox", None)
    last = src.spark.read.schema(traffic.HITS).parquet(f"{base}/inbox").agg(F.max("ts").alias("ts"))
    end = F.col("ts") + F.expr("INTERVAL 1000 DAYS")
    closing = last.select(end.alias("ts"), end.alias("arrived"))
    closing.write.mode("append").parquet(f"{base}/inbox")
    done = traffic.run_sessions(src.spark, f"{base}/inbox", f"{base}/sessions", f"{base}/checkpoint", SESSION_GAP, files_per_trigger=4)
    return done.drop("day")


# Platform tools

_add(
    google_campaign_performance=_ranged(platform_tools.google_campaign_performance),
    google_list_campaigns=platform_tools.google_list_campaigns,
    meta_campaign_insights=_ranged(platform_tools.meta_campaign_insights),
    meta_list_campaigns=platform_tools.meta_list_campaigns,
    ga4_traffic_by_channel=_ranged(platform_tools.ga4_traffic_by_channel),
    ga4_daily_trends=lambda src: platform_tools.ga4_daily_trends(src, "organic_search"),
    contacts_summary=platform_tools.contacts_summary,
    deal_stage_summary=platform_tools.deal_pipeline_summary,
    search_contacts=lambda src: platform_tools.search_contacts(src, "Nation_1"),
    opportunity_stages=platform_tools.opportunity_pipeline,
    revenue_by_source=platform_tools.revenue_by_source,
)

# Panels

for _panel in (
    panels.daily_revenue_range, panels.weekly_revenue, panels.weekly_spend, panels.ga4_channel_summary,
    panels.ga4_weekly_by_channel, panels.ga4_weekly_totals, panels.ga4_by_device, panels.google_perf,
    panels.meta_perf, panels.google_weekly, panels.meta_weekly, panels.top_categories,
    panels.revenue_by_state, panels.payment_distribution, panels.review_distribution,
    panels.delivery_stats, panels.weekly_aov, panels.hubspot_weekly, panels.kpi_summary,
    panels.weekly_roas, panels.funnel_overview, panels.engagement_by_channel, panels.spend_by_type,
    panels.platform_roas, panels.payment_share,
):
    QUERIES[_panel.__name__] = _ranged(_panel)

_add(
    attribution_ranked=panels.attribution_ranked,
    top_channel=panels.top_channel,
    ranked_channel_funnel=panels.pipeline_ranked,
    hubspot_stages=panels.hubspot_stages,
    sf_stages=panels.sf_stages,
    hubspot_by_source=panels.hubspot_by_source,
    sf_by_source=panels.sf_by_source,
    customer_segments=panels.customer_segments,
    lead_source_perf=panels.lead_source_perf,
    revenue_histogram=panels.revenue_histogram,
    sparkline=lambda src: panels.sparkline(panels.weekly_revenue(src), "week", "total_revenue"),
    sessions_pivot=lambda src: panels.sessions_pivot(src, adapters.CHANNEL_GROUPS, FIRST, LAST),
    attribution_long=panels.attribution_long,
    share_of_total=panels.linear_share,
    segment_share=panels.segment_share,
)

# Insights

_add(
    rolling_avg=insights.sessions_rolling_avg,
    detect_anomalies=insights.session_anomalies,
    funnel_steps=lambda src: insights.funnel_steps(insights.traffic_funnel(src), "channel_group"),
    validate_funnel=lambda src: insights.validate_funnel(insights.campaign_funnel(src), "campaign_name"),
    campaign_leaderboard=insights.campaign_leaderboard,
    campaign_status=insights.campaign_statuses,
    top_bottom_campaigns=insights.top_bottom_campaigns,
    budget_pacing=insights.budget_pacing,
    channel_mix_weekly=insights.channel_mix_weekly,
    waterfall_by_channel=insights.waterfall_by_channel,
    efficiency_points=insights.efficiency_points,
    platform_comparison=insights.platform_comparison,
    daily_spend_trend=insights.daily_spend_trend,
    crm_stage_funnel=insights.crm_stage_funnel,
    crm_kpis=insights.pipeline_kpis,
    deal_age_heatmap=insights.deal_age_heatmap,
    days_to_close=insights.pipeline_velocity_days,
    lifecycle_distribution=insights.lifecycle_distribution,
    spend_vs_revenue_weekly=insights.spend_vs_revenue_weekly,
    cvr_tier=insights.channel_cvr_tiers,
    static_kpis=insights.static_kpis,
    channel_share=insights.channel_share,
    weekly_spend_outer=insights.weekly_spend_outer,
    attribution_summary=insights.attribution_summary,
    traffic_kpis=insights.traffic_kpis,
    channel_conversion_funnel=insights.channel_conversion_funnel,
)


@query
def roas_tier(src: Sources) -> DataFrame:
    """Tier of every campaign day by the platform's own ROAS."""
    return src.model(int_campaign_unified).select(
        "date", "campaign_name", "roas", fm.roas_tier(F.col("roas")).alias("tier")
    )


# Scalar metric functions


@query
def google_roas(src: Sources) -> DataFrame:
    roas = fm.google_roas(F.col("conversions"), F.col("cost"))
    return src.model(stg_google_ads_performance).select("date", "campaign_id", roas.alias("est_roas"))


@query
def meta_roas(src: Sources) -> DataFrame:
    return src.model(stg_meta_ads_performance).select(
        "date", "campaign_id", fm.meta_roas(F.col("roas")).alias("platform_roas")
    )


@query
def session_cvr(src: Sources) -> DataFrame:
    cvr = fm.session_cvr(F.col("conversions"), F.col("sessions"))
    return src.model(stg_ga4_sessions).select("date", "channel_group", "device_category", cvr.alias("cvr"))


@query
def click_cvr(src: Sources) -> DataFrame:
    cvr = fm.click_cvr(F.col("conversions"), F.col("clicks"))
    return src.model(int_campaign_unified).select("date", "campaign_name", cvr.alias("cvr"))


@query
def normalised_attribution(src: Sources) -> DataFrame:
    shares = src.model(fct_marketing_attribution).select("channel", "linear_revenue")
    return normalise_attribution(shares, "linear_revenue")


@query
def formatted_metrics(src: Sources) -> DataFrame:
    """Display strings of the channel table."""
    spend, revenue = F.col("total_spend"), F.col("attributed_revenue")
    return src.model(fct_channel_performance).select(
        "channel",
        fm.fmt_money(spend).alias("spend_text"),
        fm.fmt_money(revenue, "precise").alias("revenue_text"),
        fm.fmt_count(F.col("total_orders")).alias("orders_text"),
        fm.fmt_pct(F.col("roas")).alias("pct_text"),
        fm.fmt_roas(F.col("roas")).alias("roas_text"),
    )


@query
def fiscal_quarter(src: Sources) -> DataFrame:
    return (
        src.model(stg_orders)
        .groupBy(fm.fiscal_quarter(F.col("order_date")).alias("quarter"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )


@query
def ad_ratios(src: Sources) -> DataFrame:
    """Derived ad ratios per platform and category, from summed bases."""
    summed = (
        src.model(int_campaign_unified)
        .groupBy("platform", "campaign_category")
        .agg(
            *[F.sum(c).alias(c) for c in ("impressions", "clicks", "conversions")],
            money_sum("spend").alias("spend"),
            money_sum("revenue").alias("revenue"),
        )
    )
    ratios = fm.ad_ratios(*[F.col(c) for c in ("impressions", "clicks", "spend", "conversions", "revenue")])
    return summed.select("platform", "campaign_category", *[v.alias(k) for k, v in ratios.items()])


# Builders


@query
def orders_with_revenue(src: Sources) -> DataFrame:
    paid = builders.orders_with_revenue(src.model(stg_orders), src.model(stg_order_payments))
    return paid.select("order_id", "customer_id", "order_purchase_timestamp", "revenue")


@query
def contacts_rollup(src: Sources) -> DataFrame:
    paid = builders.orders_with_revenue(src.model(stg_orders), src.model(stg_order_payments))
    return builders.contacts_rollup(src.model(stg_customers), paid)


def _touchpoints(src: Sources) -> DataFrame:
    events = src.table("web_events")
    touches = events.filter(F.col("event_type").isin("view", "click")).select(
        "customer_id", "channel", F.col("event_date").alias("touch_date")
    )
    purchases = events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("order_id"), "customer_id", F.col("event_date").alias("order_date")
    )
    return builders.build_touchpoints(touches, purchases)


@query
def assign_touch_credits(src: Sources) -> DataFrame:
    """Credits for the touchpoints of web purchases (at most one per channel and day of an order)."""
    credited = builders.assign_touch_credits(_touchpoints(src), ["touch_date", "channel"])
    return credited.select(
        "order_id", "channel", "touch_date", "touchpoint_position", "total_touchpoints",
        "first_touch_credit", "last_touch_credit", "linear_credit",
    )


_add(
    build_touchpoints=_touchpoints,
    deals_from_orders=lambda src: src.table("hubspot_deals"),
    opportunities_from_orders=lambda src: src.table("salesforce_opportunities"),
    accounts_from_sellers=lambda src: src.table("salesforce_accounts"),
)

# Lead scoring


def _lead_model(src: Sources, features: DataFrame | None = None) -> PipelineModel:
    """The model of these tables, trained once for each ``Sources``; ``features`` are the lead features where they are stored already."""
    if "lead_model" not in src.memo:
        leads = scoring.split(scoring.lead_features(src) if features is None else features)
        src.memo["lead_model"] = scoring.train_lead_model(leads.filter(~F.col("is_test")))
    return src.memo["lead_model"]


def _test_leads(src: Sources) -> DataFrame:
    return scoring.split(scoring.lead_features(src)).filter(F.col("is_test"))


@query
def train_lead_model(src: Sources) -> DataFrame:
    """The trained model's features in order, whether their weights are shares of one, and the leads it was trained and tested on."""
    weights = _lead_model(src).stages[-1].featureImportances.toArray()
    shares = abs(float(weights.sum()) - 1) < 1e-9 and float(weights.min()) >= 0
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(n).alias("feature"), F.lit(bool(shares)).alias("weights_are_shares"))
        for i, n in enumerate(scoring.FEATURES[: len(weights)], 1)
    ]
    counts = scoring.split(scoring.lead_features(src)).agg(
        count_if(~F.col("is_test")).alias("train_leads"),
        count_if(F.col("is_test")).alias("test_leads"),
        F.sum("is_won").alias("won_leads"),
    )
    return counts.select(F.inline(F.array(*entries)), "train_leads", "test_leads", "won_leads")


@query
def evaluate(src: Sources) -> DataFrame:
    """All metrics of a model whose label is one of its features, so that each must be 1."""
    leads = scoring.split(scoring.lead_features(src).withColumn("is_won", F.col("is_first_visit")))
    model = scoring.train_lead_model(leads.filter(~F.col("is_test")), maxIter=5)
    return scoring.evaluate(model, leads.filter(F.col("is_test")))


@query
def score_leads(src: Sources) -> DataFrame:
    """Each lead with the boost, cap and tier of a probability of 0.75, and whether the model's own score keeps their rules."""
    scored = scoring.score_leads(_lead_model(src), scoring.lead_features(src))
    own = F.col("score").between(0, 1) & (F.col("lead_tier") == fm.lead_tier(F.col("score")))
    fixed = scoring.boosted_score(F.lit(0.75), F.col("channel"))
    return scoring.with_tier(scored.select("contact_id", "channel", own.alias("score_keeps_rules"), fixed.alias("score")))


@query
def stump_scores(src: Sources) -> DataFrame:
    """Scores, tiers and alerts of a model of one tree with one split, which SQL can state in full."""
    leads = scoring.split(scoring.lead_features(src))
    model = scoring.train_lead_model(leads.filter(~F.col("is_test")), maxIter=1, maxDepth=1, maxBins=1024)
    score = F.col("score")
    return scoring.score_leads(model, leads).select(
        "contact_id", "channel", half_up(score, 6).alias("score"), "lead_tier", "recommendation", (score > 0.8).alias("alert")
    )


@query
def lead_tier(src: Sources) -> DataFrame:
    """Tier and recommendation of the rule score."""
    return scoring.with_tier(scoring.rule_scored_leads(src)).drop("tier")


@query
def run_log(src: Sources) -> DataFrame:
    """A logged run: its id, parameters and the names of its metrics that lie between 0 and 1 or are undefined."""
    result = scoring.evaluate(_lead_model(src), _test_leads(src))
    log = scoring.run_log(src.spark, scratch_dir(src.spark, "runs"), "run-1", scoring.PARAMS, result)
    names = F.array_sort(F.map_keys(F.map_filter("metrics", lambda _, v: v.isNull() | v.between(0, 1))))
    params = F.transform(F.array_sort(F.map_entries("params")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return log.select("run_id", F.array_join(params, ",").alias("params"), F.array_join(names, ",").alias("metrics"))


@query
def saved_model(src: Sources) -> DataFrame:
    """Each lead, and whether a model that was saved and loaded again gives it the same score."""
    folder = scratch_dir(src.spark, "model")
    scoring.save_model(_lead_model(src), folder)
    leads = scoring.lead_features(src)
    before = scoring.score_leads(_lead_model(src), leads).select("contact_id", "score")
    after = scoring.score_leads(scoring.load_model(folder), leads).select("contact_id", F.col("score").alias("again"))
    return before.join(after, "contact_id").select("contact_id", (F.col("score") == F.col("again")).alias("same_score"))


_add(
    lead_features=scoring.lead_features,
    split=lambda src: scoring.split(scoring.lead_features(src)).select("contact_id", "is_test"),
    rule_score=scoring.rule_scored_leads,
)


@query
def routed_leads(src: Sources) -> DataFrame:
    """Leads arriving as files, scored and routed by a streaming job; whether each is routed as its score says."""
    base = scratch_dir(src.spark, "routing")
    # worked out once: the model learns from these files, the stream takes them in without the outcome, and they are scored again
    scoring.lead_features(src).write.parquet(f"{base}/inbox")
    stored = src.spark.read.parquet(f"{base}/inbox")
    leads = stored.drop("is_won")
    model = _lead_model(src, stored)
    routed = route_leads(
        src.spark, f"{base}/inbox", StructType(leads.schema.fields), model, f"{base}/alerts", f"{base}/checkpoint", files_per_trigger=4
    )
    alerts = routed.groupBy("contact_id").agg(F.count(F.lit(1)).alias("alerts"))
    due = F.when(F.col("score") > 0.8, 1).otherwise(0)
    scored = scoring.score_leads(model, leads).select("contact_id", due.alias("due"))
    return scored.join(alerts, "contact_id", "left").select(
        "contact_id", (F.coalesce("alerts", F.lit(0)) == F.col("due")).alias("routed_by_score")
    )


# Data quality

_add(
    check_not_null=lambda src: quality.check_not_null(src.model(stg_orders), "order_delivered_customer_date"),
    check_unique=lambda src: quality.check_unique(src.model(stg_order_items), "order_id"),
    check_accepted_values=lambda src: quality.check_accepted_values(
        src.model(stg_orders), "order_status", ["delivered", "shipped"]
    ),
    run_checks_staging=lambda src: quality.run_checks(src, quality.STAGING_CHECKS),
    run_checks_marts=lambda src: quality.run_checks(src, quality.MART_CHECKS),
)



@query
def reference_report(src: Sources) -> DataFrame:
    """References between the staging tables, with the customers who never ordered and the products never sold."""
    t = {fn.__name__: src.model(fn) for fn in (stg_orders, stg_order_items, stg_order_payments, stg_customers, stg_sellers)}
    t["web_hits"] = src.table("web_hits")
    edges = [
        ("stg_order_items", "order_id", "stg_orders", "order_id"),
        ("stg_order_payments", "order_id", "stg_orders", "order_id"),
        ("stg_orders", "customer_id", "stg_customers", "customer_id"),
        ("stg_customers", "customer_id", "stg_orders", "customer_id"),
        ("stg_order_items", "seller_id", "stg_sellers", "seller_id"),
        ("stg_sellers", "seller_id", "stg_order_items", "seller_id"),
        ("web_hits", "customer_id", "stg_customers", "customer_unique_id"),
    ]
    return check_references([(a, t[a], column, b, t[b], key) for a, column, b, key in edges])


@query
def places_changed(src: Sources) -> DataFrame:
    """Places of customers and of sellers as two bags: those held in different numbers."""
    old = src.model(stg_customers).select(F.col("customer_city").alias("city"), F.col("customer_state").alias("state"))
    new = src.model(stg_sellers).select(F.col("seller_city").alias("city"), F.col("seller_state").alias("state"))
    return table_difference(old, new)


# Attributes of web events

@query
def event_attributes(src: Sources) -> DataFrame:
    return attribute_rows(src.table("web_hits"), ["event_id"], "props")


@query
def attribute_by_channel(src: Sources) -> DataFrame:
    """Events, and range and sum of the attribute k, by channel."""
    typed = typed_attributes(src.table("web_hits").select("channel", "props"), "props", "k long")
    return typed.groupBy("channel").agg(
        F.count("k").alias("events"), F.min("k").alias("least"), F.max("k").alias("most"), F.sum("k").alias("total")
    )


# Ranges and increments


@query
def deal_age_bands(src: Sources) -> DataFrame:
    """Open deals by stage in bands of age that overlap, the last without an end; ages at the latest creation."""
    bands = [("month_one", 0, 31), ("month_two", 31, 61), ("quarter", 0, 91), ("past_target", 45, None)]
    rows = [F.struct(F.lit(n).alias("band"), F.lit(a).alias("from_age"), F.lit(b).cast("int").alias("to_age")) for n, a, b in bands]
    # one row per stage and age before the join
    met = range_join(insights.open_deal_ages(src), "age", src.spark.range(1).select(F.inline(F.array(*rows))), "from_age", "to_age")
    return met.groupBy("band", "stage").agg(F.sum("n").alias("deals"))


@query
def marketing_daily_increments(src: Sources) -> DataFrame:
    """``fct_marketing_daily`` taken in by three loads: odd months, even months, and the fifteenth of every fourth month late."""
    names = ("google_ads_daily_performance", "meta_ads_daily_performance", "ga4_daily_sessions")
    late = (F.dayofmonth("date") == 15) & (F.month("date") % 4 == 0)
    load = F.when(late, 3).otherwise(F.when(F.month("date") % 2 == 1, 1).otherwise(2)).cast("long")
    tables = {n: src.table(n).withColumn("load_id", load) for n in names}
    path = scratch_dir(src.spark, "increments")
    for last in (1, 2, 3):
        seen = {n: df.filter(F.col("load_id") <= last) for n, df in tables.items()}
        refresh_changed_months(seen, fct_marketing_daily, path)
    return read_mart(src.spark, path)
