"""Governed metrics: measures over models, derived ratios over metrics, one query function."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions.frames import merge_on
from martlet.functions.numeric import count_if, half_up, in_range, money_mean, money_sum, ratio, week
from martlet.operators.intermediate import int_campaign_unified
from martlet.operators.marts import (
    fct_channel_performance,
    fct_daily_revenue,
    fct_marketing_daily,
    fct_orders,
    order_revenue,
)
from martlet.operators.staging import (
    stg_ga4_sessions,
    stg_hubspot_deals,
    stg_salesforce_opportunities,
)
from martlet.sources.registry import Sources


def crm_pipeline(src: Sources) -> DataFrame:
    """Deals and opportunities of both CRMs as one table, with the CRM as ``source``."""
    deals = src.model(stg_hubspot_deals).select(
        F.lit("hubspot").alias("source"),
        "deal_id",
        F.col("deal_stage").alias("stage"),
        "lead_source",
        "amount",
        F.lit(None).cast("double").alias("weighted_amount"),
        "create_date",
        "close_date",
    )
    opportunities = src.model(stg_salesforce_opportunities).select(
        F.lit("salesforce").alias("source"),
        F.col("opportunity_id").alias("deal_id"),
        "stage",
        "lead_source",
        "amount",
        "weighted_amount",
        F.col("created_date").alias("create_date"),
        "close_date",
    )
    return deals.unionByName(opportunities)


@dataclass(frozen=True)
class Model:
    """A table with a default time column (None: no time) and the dimensions one may group by."""

    frame: Callable[[Sources], DataFrame]
    time: str | None
    dimensions: tuple[str, ...] = ()
    # columns that a cheaper frame offers, and that frame
    lean: Callable[[Sources], DataFrame] | None = None
    lean_columns: frozenset[str] = field(default_factory=frozenset)

    def resolve(self, src: Sources, needed: list[str], free_filter: bool) -> DataFrame:
        if self.lean is not None and not free_filter and set(needed) <= self.lean_columns:
            return src.model(self.lean)
        return src.model(self.frame)


ORDER_COLUMNS = frozenset({"order_date", "order_status", "primary_payment_type"})

MODELS = {
    "orders": Model(
        fct_orders,
        "order_date",
        ("last_touch_channel", "first_touch_channel", "primary_payment_type", "order_status", "customer_state"),
        order_revenue,
        ORDER_COLUMNS,
    ),
    "marketing_daily": Model(fct_marketing_daily, "date"),
    "campaigns": Model(int_campaign_unified, "date", ("platform", "campaign_name", "campaign_category")),
    "ga4_sessions": Model(stg_ga4_sessions, "date", ("channel_group", "device_category")),
    "channel_performance": Model(fct_channel_performance, None, ("channel",)),
    "crm_pipeline": Model(crm_pipeline, "close_date", ("stage", "source", "lead_source")),
    "daily_revenue": Model(fct_daily_revenue, "order_date"),
}


@dataclass(frozen=True)
class Simple:
    model: str
    measure: Callable[[], Column]


@dataclass(frozen=True)
class Derived:
    """numerator / denominator, evaluated on the aggregated metrics (a ratio of sums)."""

    numerator: str
    denominator: str


METRICS: dict[str, Simple | Derived] = {
    "total_revenue": Simple("orders", lambda: money_sum("revenue")),
    "total_spend": Simple("marketing_daily", lambda: money_sum("total_spend")),
    "total_sessions": Simple("ga4_sessions", lambda: F.sum("sessions")),
    "total_clicks": Simple("campaigns", lambda: F.sum("clicks")),
    "total_new_users": Simple("ga4_sessions", lambda: F.sum("new_users")),
    "total_engaged_sessions": Simple("ga4_sessions", lambda: F.sum("engaged_sessions")),
    "total_orders": Simple("orders", lambda: F.count_distinct("order_id")),
    "average_order_value": Simple("orders", lambda: money_mean("revenue")),
    "total_pipeline_value": Simple("crm_pipeline", lambda: money_sum("amount")),
    "total_deals": Simple("crm_pipeline", lambda: F.count_distinct("deal_id")),
    "channel_spend": Simple("channel_performance", lambda: money_sum("total_spend")),
    "channel_revenue": Simple("channel_performance", lambda: money_sum("attributed_revenue")),
    "channel_orders": Simple("channel_performance", lambda: F.sum("total_orders")),
    "ga4_conversions": Simple("ga4_sessions", lambda: F.sum("conversions")),
    "ad_conversions": Simple("marketing_daily", lambda: F.sum("total_conversions")),
    "new_customers": Simple("daily_revenue", lambda: F.sum("new_customers")),
    "won_deals": Simple("crm_pipeline", lambda: count_if(_won())),
    "closed_deals": Simple("crm_pipeline", lambda: count_if(_won() | _lost())),
    "blended_roas": Derived("total_revenue", "total_spend"),
    "channel_roas": Derived("channel_revenue", "channel_spend"),
    "customer_acquisition_cost": Derived("channel_spend", "channel_orders"),
    "cost_per_session": Derived("total_spend", "total_sessions"),
    "engagement_rate": Derived("total_engaged_sessions", "total_sessions"),
    "session_conversion_rate": Derived("total_orders", "total_sessions"),
    "win_rate": Derived("won_deals", "closed_deals"),
    "blended_cac": Derived("total_spend", "new_customers"),
}


def _won() -> Column:
    return F.col("stage").isin("closed_won", "Closed Won")


def _lost() -> Column:
    return F.col("stage").isin("closed_lost", "Closed Lost")


def _grain(day: Column, grain: str) -> Column:
    if grain == "day":
        return day.cast("date")
    return week(day) if grain == "week" else F.date_trunc(grain, day).cast("date")


def _simple_parts(name: str) -> list[str]:
    metric = METRICS[name]
    if isinstance(metric, Simple):
        return [name]
    return _simple_parts(metric.numerator) + _simple_parts(metric.denominator)


def query_metric(
    src: Sources,
    metrics: list[str],
    group_by: list[str] | None = None,
    grain: str | None = None,
    start=None,
    end=None,
    where: str | None = None,
    totals: str | bool = False,
) -> DataFrame:
    """Metrics by dimensions and time grain (``metric_time``).

    Each model is filtered on its time column, grouped and aggregated on its own; the small
    results are then merged on the group keys and the derived ratios evaluated. ``where`` is a
    SQL condition on the model's columns.

    With ``totals`` there are subtotals as well: of the leading keys (True or "rollup") or of all subsets ("cube"). ``level`` is then the
    grouping id: a bit for each key, the first the highest, that is set where the row is a total over that key; so a total is told
    apart from a group whose key is null. Each model is expanded once for all levels, and ratios are formed of the totals, not summed.
    """
    if totals not in (False, True, "rollup", "cube"):
        raise ValueError(f"totals is rollup or cube, not {totals}")
    group_by = list(group_by or [])
    by_model: dict[str, list[str]] = {}
    for part in dict.fromkeys(p for m in metrics for p in _simple_parts(m)):
        by_model.setdefault(METRICS[part].model, []).append(part)

    results = []
    for model_name, parts in by_model.items():
        model = MODELS[model_name]
        unknown = [d for d in group_by if d not in model.dimensions]
        if unknown:
            raise ValueError(f"{model_name} has no dimension {', '.join(unknown)}")
        if model.time is None and (grain or start or end):
            raise ValueError(f"{model_name} has no time column")
        needed = group_by + ([model.time] if model.time else [])
        df = model.resolve(src, needed, where is not None)
        if model.time and (start or end):
            df = df.filter(in_range(model.time, start, end))
        if where:
            df = df.filter(where)
        keys = [F.col(d) for d in group_by]
        if grain:
            keys = [_grain(F.col(model.time), grain).alias("metric_time"), *keys]
        measures = [METRICS[p].measure().alias(p) for p in parts]
        if totals:
            grouped = df.cube(*keys) if totals == "cube" else df.rollup(*keys)
            results.append(grouped.agg((F.grouping_id() if keys else F.lit(0)).cast("long").alias("level"), *measures))
        else:
            results.append(df.groupBy(*keys).agg(*measures))

    key_names = (["metric_time"] if grain else []) + group_by + (["level"] if totals else [])
    merged = merge_on(key_names, results)
    return merged.select(*key_names, *[_evaluate(m).alias(m) for m in metrics])


def _evaluate(name: str) -> Column:
    metric = METRICS[name]
    if isinstance(metric, Simple):
        return F.col(name)
    return ratio(_evaluate(metric.numerator), _evaluate(metric.denominator))


def pipeline_velocity(src: Sources, start=None, end=None) -> DataFrame:
    """Probability-weighted pipeline value per day of the period (one row).

    The period is the given range, else the span of the creation dates. Only opportunities carry
    a probability, so only they are weighted.
    """
    deals = src.model(crm_pipeline).filter(
        in_range("create_date", start, end) & F.col("weighted_amount").isNotNull()
    )
    first = F.lit(str(start)).cast("date") if start else F.min("create_date")
    last = F.lit(str(end)).cast("date") if end else F.max("create_date")
    return deals.agg(
        half_up(F.sum("weighted_amount"), 4).alias("weighted_value"),
        (F.datediff(last, first) + 1).alias("days"),
    ).withColumn("pipeline_velocity", ratio(F.col("weighted_value"), F.col("days")))
