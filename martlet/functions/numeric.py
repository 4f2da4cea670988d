"""Sums, means and ratios with one rounding rule.

Adding doubles in a different order changes the last bits, and on a cluster the order is never
the same twice. Money is therefore rounded to cents right after it is summed, and whatever is
derived from those sums is plain arithmetic, so a result does not depend on the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(value: Column, digits: int) -> Column:
    """Round half away from zero on the decimal value (binary noise is dropped first)."""
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def money_sum(value: Column | str) -> Column:
    return half_up(F.sum(value), 2)


def money_mean(value: Column | str) -> Column:
    return F.try_divide(money_sum(value), F.count(value))


def mean(value: Column | str, digits: int = 6) -> Column:
    return half_up(F.avg(value), digits)


def count_if(condition: Column) -> Column:
    """Rows that satisfy the condition; 0 (never NULL) when none does."""
    return F.count(F.when(condition, F.lit(1)))


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, NULL when bottom is zero or NULL."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def guarded(top: Column, bottom: Column) -> Column:
    """top / bottom, 0 unless bottom is positive."""
    return F.when(bottom > 0, ratio(top, bottom)).otherwise(F.lit(0.0))


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def pick(choices: list[str], position: Column) -> Column:
    """The entry of a fixed list at a 0-based position."""
    return F.element_at(F.array(*[F.lit(c) for c in choices]), (position + 1).cast("int"))


def week(day: Column | str) -> Column:
    """Monday of the week, as a date."""
    return F.date_trunc("week", day).cast("date")


def in_range(day: Column | str, start=None, end=None) -> Column:
    """Inclusive date range; an open end is no limit. Compares dates, so parquet statistics apply."""
    col = F.col(day) if isinstance(day, str) else day
    keep = F.lit(True)
    if start is not None:
        keep = keep & (col >= F.lit(str(start)).cast("date"))
    if end is not None:
        keep = keep & (col <= F.lit(str(end)).cast("date"))
    return keep
