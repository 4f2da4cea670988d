"""As-of join: what was known of a key at a moment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, values: list[str], slice_unit: str = "day"
) -> DataFrame:
    """The left rows with the ``values`` of the last right row of their key at or before their time; nulls if there is none.

    Both sides go into one stream of rows a key, in which the last state seen is carried forward: no pairs are formed. A
    key is cut into slices of time (``slice_unit`` as in ``date_trunc``), sorted by a task each, and what is known before a slice comes from one row
    per slice, so a key with most of the rows is the work of as many tasks as it has slices. It is one lazy plan. Of right rows
    of one key and time the one with the greatest values counts. A null key or time on either side meets nothing.
    """
    known = F.lit(True)
    for k in [*keys, right_time]:
        known = known & F.col(k).isNotNull()
    # a struct is never null, so a plain equality joins slices with null keys too
    at = lambda time: F.struct(F.struct(*keys).alias("key"), F.date_trunc(slice_unit, F.col(time)).alias("slice")).alias("_at")
    state = F.struct(*values)
    states = right.filter(known).groupBy(*keys, F.col(right_time).alias("_t")).agg(F.max(state).alias("_state"))
    states = states.select(at("_t"), "_t", F.lit(0).alias("_side"), "_state")
    touches = left.select(at(left_time), F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"))
    both = states.unionByName(touches, allowMissingColumns=True)
    # carried across slices: one row for each
    slices = both.groupBy(F.col("_at").alias("_of")).agg(F.max_by("_state", F.when(F.col("_side") == 0, F.col("_t"))).alias("_last"))
    before = Window.partitionBy("_of.key").orderBy("_of.slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select("_of", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    so_far = Window.partitionBy("_at").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    now = both.withColumn("_now", F.last("_state", ignorenulls=True).over(so_far)).filter(F.col("_row").isNotNull())
    out = now.join(carried, F.col("_at") == F.col("_of")).withColumn("_now", F.coalesce("_now", "_carried"))
    return out.select("_row.*", *[F.col("_now")[v].alias(v) for v in values])
