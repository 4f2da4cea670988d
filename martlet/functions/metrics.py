"""Scalar metric rules: ROAS, conversion rates, tiers, time decay, display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martlet.functions.numeric import half_up

# Fixed value: the revenue assumed for one search-ad conversion.
ASSUMED_ORDER_VALUE = 100.0


def _or_zero(value: Column, base: Column) -> Column:
    """0 when the base is 0 or NULL."""
    return F.when(base.isNull() | (base == 0), F.lit(0.0)).otherwise(value)


def google_roas(conversions: Column, cost: Column) -> Column:
    return _or_zero(half_up(F.try_divide(conversions * F.lit(ASSUMED_ORDER_VALUE), cost), 2), cost)


def meta_roas(platform_roas: Column) -> Column:
    return half_up(platform_roas, 2)


def session_cvr(conversions: Column, sessions: Column) -> Column:
    """Conversions per 100 sessions (the cross-channel rate)."""
    return _or_zero(half_up(F.try_divide(conversions * F.lit(100.0), sessions), 2), sessions)


def click_cvr(conversions: Column, clicks: Column) -> Column:
    """Conversions per 100 ad clicks (platform tables only)."""
    return _or_zero(half_up(F.try_divide(conversions * F.lit(100.0), clicks), 2), clicks)


def campaign_status(roas: Column) -> Column:
    return F.when(roas >= 3, "Scale").when(roas < 1, "Pause").otherwise("Watch")


def cvr_tier(cvr_percent: Column) -> Column:
    return F.when(cvr_percent >= 3.5, "good").when(cvr_percent >= 2, "mid").otherwise("low")


def roas_tier(roas: Column) -> Column:
    return F.when(roas >= 8, "high").when(roas >= 3, "mid").otherwise("low")


def lead_tier(score: Column) -> Column:
    return F.when(score > 0.8, "A").when(score > 0.5, "B").otherwise("C")


def lead_recommendation(score: Column) -> Column:
    # The two texts.
    return F.when(score > 0.8, "High priority: Instant sales follow-up").otherwise(
        "Nurture: Add to email drip"
    )


def time_decay_credit(touch_date: Column, order_date: Column, half_life: float = 7.0) -> Column:
    """Halves for every ``half_life`` days between touch and order. Not normalised per order."""
    days = F.datediff(order_date.cast("date"), touch_date.cast("date"))
    return F.pow(F.lit(2.0), -days / F.lit(float(half_life)))


def fiscal_quarter(day: Column) -> Column:
    return F.concat(
        F.lit("Q"), F.quarter(day).cast("string"), F.lit(" "), F.year(day).cast("string")
    )


def ad_ratios(impressions: Column, clicks: Column, cost: Column, conversions: Column, value: Column):
    """Derived ad columns by name; a zero base counts as 1 (0.01 for money)."""
    one = F.lit(1)
    return {
        "ctr": half_up(F.lit(100.0) * clicks / F.greatest(impressions, one), 2),
        "cpc": half_up(cost / F.greatest(clicks, one), 2),
        "cpm": half_up(F.lit(1000.0) * cost / F.greatest(impressions, one), 2),
        "cost_per_conversion": half_up(cost / F.greatest(conversions, one), 2),
        "roas": half_up(value / F.greatest(cost, F.lit(0.01)), 2),
    }


def _fixed(value: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", value)


def fmt_money(value: Column, style: str = "compact") -> Column:
    """``compact``: $1.2M / $3.4K / $56.  ``precise``: $1.23M, else always in K ($0.1K)."""
    if style == "precise":
        mega, small = 2, F.concat(F.lit("$"), _fixed(half_up(value / 1e3, 1), 1), F.lit("K"))
    else:
        kilo = F.concat(F.lit("$"), _fixed(half_up(value / 1e3, 1), 1), F.lit("K"))
        plain = F.concat(F.lit("$"), _fixed(half_up(value, 0), 0))
        mega, small = 1, F.when(value >= 1e3, kilo).otherwise(plain)
    millions = F.concat(F.lit("$"), _fixed(half_up(value / 1e6, mega), mega), F.lit("M"))
    return F.when(value >= 1e6, millions).otherwise(small)


def fmt_pct(value: Column, digits: int = 1) -> Column:
    return F.concat(_fixed(half_up(value, digits), digits), F.lit("%"))


def fmt_roas(value: Column) -> Column:
    return F.concat(_fixed(half_up(value, 2), 2), F.lit("×"))


def fmt_count(value: Column) -> Column:
    """12.3K from 1000 upwards, else the whole number."""
    kilo = F.concat(_fixed(half_up(value / 1e3, 1), 1), F.lit("K"))
    return F.when(value >= 1000, kilo).otherwise(value.cast("long").cast("string"))
