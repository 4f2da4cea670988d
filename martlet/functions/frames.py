"""Small frame helpers: totals, shares, one-row frames and keyed merges."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions.numeric import half_up


def union_all(frames: Iterable[DataFrame], fill: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill), frames)


def merge_on(keys: list[str], frames: list[DataFrame]) -> DataFrame:
    """Full outer merge of frames that hold at most one row per key and no common value column.

    Union, then one aggregate: a single shuffle for any number of frames, and a NULL key meets a
    NULL key. Without keys it merges one-row frames into one row.
    """
    values = [c for df in frames for c in df.columns if c not in keys]
    if len(frames) == 1:
        return frames[0]
    stacked = union_all(frames, fill=True)
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])


def share_of_total(df: DataFrame, value: str, name: str = "share_pct", digits: int = 6) -> DataFrame:
    """Adds each row's share of the column's sum in percent; NULL when the sum is 0.

    The sum is a one-value subquery: no global window and no join.
    """
    total = df.agg(F.sum(value)).scalar()
    share = F.try_divide(F.col(value) * F.lit(100.0), total)
    return df.withColumn(name, half_up(share, digits))


def normalise_attribution(df: DataFrame, value: str) -> DataFrame:
    """Values as a share of their sum, one decimal; unchanged when the sum is 0.

    Rounding means that the shares need not add up to exactly 100.
    """
    total = df.agg(F.sum(value)).scalar()
    share = half_up(F.try_divide(F.col(value) * F.lit(100.0), total), 1)
    return df.withColumn(value, F.coalesce(share, F.col(value).cast("double")))


def last_points(df: DataFrame, date: str, value: str, n: int = 14) -> DataFrame:
    """The last n non-null points of a series by date."""
    return df.select(date, value).filter(F.col(value).isNotNull()).orderBy(F.col(date).desc()).limit(n)


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)
