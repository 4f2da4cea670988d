"""Joins on ranges, without an equality to join on: values within ranges, and ranges that overlap."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions.frames import union_all

STEP_BITS = 4  # a block holds 16 blocks of the level below
TOP = 14  # the highest level; its blocks hold 2 ** 56 values
LIMIT = 1 << 59  # values lie between -LIMIT and LIMIT


def _named(level: int) -> Callable[[Column], Column]:
    return lambda block: F.struct(F.lit(level).alias("_cover_level"), block.alias("_cover_block"))


def _cover(low: Column, high: Column) -> Column:
    """The blocks (level, block) that [low, high) consists of, each as large as fits: at most 30 a level, and disjoint."""
    first = lambda level: -F.shiftright(-low, STEP_BITS * level)
    end = lambda level: F.shiftright(high, STEP_BITS * level)
    none = F.array().cast("array<bigint>")
    between = lambda a, b: F.when(a < b, F.sequence(a, b - 1)).otherwise(none)
    levels = []
    for level in range(TOP + 1):
        a, b = first(level), end(level)
        if level == TOP:
            blocks = between(a, b)
        else:
            # what whole blocks of the next level take
            up_a, up_b = first(level + 1) * (1 << STEP_BITS), end(level + 1) * (1 << STEP_BITS)
            blocks = F.when(up_a < up_b, F.concat(between(a, up_a), between(up_b, b))).otherwise(between(a, b))
        levels.append(F.transform(blocks, _named(level)))
    return F.flatten(F.array(*levels))


def range_join(points: DataFrame, value: str, ranges: DataFrame, low: str, high: str) -> DataFrame:
    """Each point with every range that holds it, low <= value < high; ranges may overlap.

    A range is cut into aligned blocks of 1, 16, 256, ... values, as large as fit: some 15 a level it spans, however long it is. A point lies
    in one block of each level, and looks at the levels in use only. That makes it a join by equality in which every meeting is a
    result, each once: nothing is compared in vain, and a block that most of the points lie in is split by the adaptive skew join.
    Values are whole numbers (days, cents, microseconds) between -2**59 and 2**59. A null bound is an open
    end; a null value meets nothing, nor does a range whose low is not below its high. The two sides share no column name.
    """
    bounds = F.coalesce(F.col(low).cast("long"), F.lit(-LIMIT)), F.coalesce(F.col(high).cast("long"), F.lit(LIMIT))
    blocks = ranges.select("*", F.inline(_cover(*bounds)))
    in_use = blocks.agg(F.collect_set("_cover_level")).scalar()
    placed = points.filter(F.col(value).isNotNull()).select("*", F.explode(in_use).alias("_level"))
    # by level, as a shift by a column is not among the functions
    block = F.when(F.lit(False), F.lit(0).cast("long"))
    for level in range(TOP + 1):
        block = block.when(F.col("_level") == level, F.shiftright(F.col(value).cast("long"), STEP_BITS * level))
    placed = placed.withColumn("_block", block)
    met = placed.join(blocks, (F.col("_level") == F.col("_cover_level")) & (F.col("_block") == F.col("_cover_block")))
    return met.drop("_level", "_block", "_cover_level", "_cover_block")


def overlap_join(left: DataFrame, right: DataFrame, left_low: str, left_high: str, right_low: str, right_high: str) -> DataFrame:
    """The pairs of a left and a right range that share a value, each once.

    Of two ranges that overlap, one begins within the other. Either the left begins within the right, or the right begins within the left
    after its first value; so the pairs are two range joins of beginnings. Bounds are as in ``range_join``: high is not
    included, null is an open end, and a range without values meets nothing.
    """
    begin = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-LIMIT))
    some = lambda df, low, high: df.filter(begin(low) < F.coalesce(F.col(high).cast("long"), F.lit(LIMIT)))
    columns = [*left.columns, *right.columns]
    left, right = some(left, left_low, left_high), some(right, right_low, right_high)
    within_right = range_join(left.withColumn("_begin", begin(left_low)), "_begin", right, right_low, right_high)
    inner = left.withColumn("_after", begin(left_low) + 1)
    within_left = range_join(right.withColumn("_begin", begin(right_low)), "_begin", inner, "_after", left_high)
    return union_all([within_right.select(*columns), within_left.select(*columns)])
