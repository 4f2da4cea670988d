"""Distinct counts over any range of days from stored sketches, without the raw ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_BUCKETS = 12  # standard error about 1.04 / sqrt(2 ** 12) = 1.6 %


def daily_sketches(df: DataFrame, keys: list[str], day: str, ident: str, lg_buckets: int = LG_BUCKETS) -> DataFrame:
    """(keys, day, sketch): a HyperLogLog sketch of the distinct ids of each day. Null ids are not counted.

    A sketch has a bounded size (4 KB at 12) whatever it has seen, and is built map-side: a hot day is one sketch a task.
    """
    return df.groupBy(*keys, day).agg(F.hll_sketch_agg(ident, lg_buckets).alias("sketch"))


def distinct_from_sketches(sketches: DataFrame, keys: list[str], day: str, first=None, last=None) -> DataFrame:
    """(keys, estimate): distinct ids of the days from ``first`` to ``last`` (both optional and included), by merging sketches."""
    if first is not None:
        sketches = sketches.filter(F.col(day) >= F.lit(first))
    if last is not None:
        sketches = sketches.filter(F.col(day) <= F.lit(last))
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
