"""Data-quality checks on the models: not null, unique, accepted values."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.frames import union_all
from martlet.operators.intermediate import time_spine
from martlet.operators.marts import MARTS
from martlet.operators.staging import STAGING
from martlet.sources.registry import Sources


@dataclass(frozen=True)
class Checks:
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    accepted: dict[str, list] = field(default_factory=dict)


# The declared assertions.
STAGING_CHECKS = {
    "stg_orders": Checks(
        ("order_id",),
        ("order_id", "customer_id", "order_status", "order_date"),
        {
            "order_status": [
                "delivered", "shipped", "canceled", "invoiced", "processing", "approved",
                "unavailable", "created",
            ]
        },
    ),
    "stg_customers": Checks(("customer_id",), ("customer_id", "customer_state")),
    "stg_order_items": Checks((), ("order_id", "price")),
    "stg_order_payments": Checks(
        (),
        ("order_id", "payment_value"),
        {"payment_type": ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]},
    ),
    "stg_order_reviews": Checks((), ("order_id", "review_score"), {"review_score": [1, 2, 3, 4, 5]}),
    "stg_products": Checks(("product_id",), ("product_id",)),
    "stg_sellers": Checks(("seller_id",), ("seller_id",)),
    "stg_ga4_sessions": Checks((), ("date", "channel_group", "sessions")),
    "stg_google_ads_performance": Checks((), ("date", "campaign_id", "cost")),
    "stg_meta_ads_performance": Checks((), ("date", "campaign_id", "spend")),
    "stg_hubspot_contacts": Checks(
        ("contact_id",),
        ("contact_id", "lifecycle_stage"),
        {
            "lifecycle_stage": [
                "subscriber", "lead", "marketing_qualified_lead", "sales_qualified_lead",
                "opportunity", "customer", "evangelist",
            ]
        },
    ),
    "stg_hubspot_deals": Checks(
        ("deal_id",),
        ("deal_id", "deal_stage", "amount"),
        {
            "deal_stage": [
                "prospecting", "qualified", "presentation_scheduled", "proposal_sent",
                "negotiation", "closed_won", "closed_lost",
            ]
        },
    ),
    "stg_salesforce_opportunities": Checks(
        ("opportunity_id",),
        ("opportunity_id", "stage", "probability"),
        {
            "stage": [
                "Prospecting", "Qualification", "Needs Analysis", "Value Proposition",
                "Proposal/Price Quote", "Negotiation/Review", "Closed Won", "Closed Lost",
            ]
        },
    ),
    "stg_marketing_attribution": Checks((), ("order_id", "channel")),
}

MART_CHECKS = {
    "fct_orders": Checks((), ("order_id", "customer_id", "order_date", "revenue")),
    "fct_marketing_daily": Checks((), ("date", "total_spend")),
    "fct_channel_performance": Checks(("channel",), ("channel", "total_spend", "attributed_revenue")),
    "fct_marketing_attribution": Checks(
        ("channel",),
        (
            "channel", "first_touch_revenue", "last_touch_revenue", "linear_revenue",
            "time_decay_revenue",
        ),
    ),
    "fct_pipeline": Checks(("attribution_channel",), ("attribution_channel",)),
    "fct_lead_scoring_features": Checks(
        ("customer_id",), ("customer_id", "total_orders", "is_high_value")
    ),
    "fct_daily_revenue": Checks(("order_date",), ("order_date", "total_revenue")),
    "dim_customers": Checks(("customer_id",), ("customer_id", "customer_state")),
    "dim_products": Checks(("product_id",), ("product_id",)),
    "dim_campaigns": Checks((), ("campaign_id",)),
    "time_spine": Checks(("date_day",), ("date_day",)),
}


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """The rows that fail."""
    return df.filter(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """The values that occur more than once, with their count (NULL is not a value)."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > 1)


def check_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """The values outside the list, with their count (NULL passes)."""
    return df.filter(~F.col(column).isin(values)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def check_table(df: DataFrame, table: str, checks: Checks) -> DataFrame:
    """One report row per assertion.

    All row-wise assertions of a table are counted in one scan; each uniqueness needs a grouping.
    """

    def entry(column: str, check: str, failures):
        return F.struct(
            F.lit(column).alias("column_name"), F.lit(check).alias("check_name"), failures.alias("failures")
        )

    failing = lambda condition: F.count(F.when(condition, F.lit(1)))
    row_wise = [entry(c, "not_null", failing(F.col(c).isNull())) for c in checks.not_null] + [
        entry(c, "accepted_values", failing(~F.col(c).isin(values))) for c, values in checks.accepted.items()
    ]
    parts = [df.agg(F.array(*row_wise).alias("_rows"))] if row_wise else []
    parts += [
        check_unique(df, c).agg(F.array(entry(c, "unique", F.count(F.lit(1)))).alias("_rows"))
        for c in checks.unique
    ]
    return (
        union_all(parts)
        .select(F.inline("_rows"))
        .select(
            F.lit(table).alias("table_name"),
            "column_name",
            "check_name",
            "failures",
            (F.col("failures") == 0).alias("passed"),
        )
    )


def run_checks(src: Sources, suite: dict[str, Checks]) -> DataFrame:
    """The report of a suite over the models it names."""
    models = {**STAGING, **MARTS, "time_spine": lambda s: time_spine(s.spark)}
    return union_all(
        check_table(src.model(models[t]) if t != "time_spine" else models[t](src), t, checks)
        for t, checks in suite.items()
    )
