"""Positions within groups of any size, in one lazy plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_rows(
    df: DataFrame, key: str, order_by: list[str], position: str, total: str | None = None, slice_by: Column | None = None
) -> DataFrame:
    """Adds each row's 1-based position in its group, and the group's size if asked for.

    A group is cut into slices by ``slice_by``, the first column of the order or something that
    never falls along the order (line numbers by the hundred, say). Rows are numbered within their slice; what precedes a
    slice is counted from one row per slice, folded before the shuffle. So a group of any size is sorted a
    slice at a time, by as many tasks as it has slices, and nothing runs before an action.
    """
    # a struct is never null, so a plain equality joins null keys too and rows keep their partitioning
    sliced = df.withColumn("_at", F.struct(F.col(key).alias("key"), (F.col(order_by[0]) if slice_by is None else slice_by).alias("slice")))
    counts = sliced.groupBy(F.col("_at").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy("_of.key")
    before = group.orderBy("_of.slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "_of",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(group).cast("int").alias("_total"),
    )
    out = (
        sliced.withColumn("_row", F.row_number().over(Window.partitionBy("_at").orderBy(*order_by)))
        .join(starts, F.col("_at") == F.col("_of"))
        .withColumn(position, (F.col("_before") + F.col("_row")).cast("int"))
    )
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.drop("_at", "_row", "_of", "_before", "_total")
