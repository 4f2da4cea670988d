"""Sessions by gaps: a key's events belong together as long as none is later than a gap after the one before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gap_sessions(events: DataFrame, key: str, time: str, gap: str, measures: dict[str, Column], slice_unit: str = "day") -> DataFrame:
    """(key, session_start, session_end, events, measures): one row a session; its end is its last event.

    ``measures`` are values per event that are summed. An event exactly one gap after the last still belongs. Rows with a null key or time
    are left out. Islands are formed within slices of time, each the work of one task, and folded to a row; whether a slice's first
    island goes on from the slice before, and where that session began, comes from one row per slice. So a key with most of the
    events is the work of many tasks, and only islands are shuffled again.
    """
    span = F.expr(f"INTERVAL {gap}")
    at = F.struct(F.col(key).alias("key"), F.date_trunc(slice_unit, F.col(time)).alias("slice"))
    rows = events.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
    rows = rows.select(at.alias("_at"), F.col(time).alias("_t"), *[m.alias(n) for n, m in measures.items()])
    within = Window.partitionBy("_at").orderBy("_t")
    prior = F.lag("_t").over(within)
    rows = rows.withColumn("_new", F.when(prior.isNull() | (F.col("_t") > prior + span), 1).otherwise(0))
    rows = rows.withColumn("_island", F.sum("_new").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    islands = rows.groupBy("_at", "_island").agg(
        F.min("_t").alias("_from"), F.max("_t").alias("_to"), F.count(F.lit(1)).alias("events"), *[F.sum(n).alias(n) for n in measures]
    )
    slices = islands.groupBy(F.col("_at").alias("_of")).agg(
        F.min("_from").alias("_first"), F.max("_to").alias("_last"), F.max("_from").alias("_newest"), F.max("_island").alias("_n")
    )
    by_slice = Window.partitionBy("_of.key").orderBy("_of.slice")
    slices = slices.withColumn("_goes_on", F.coalesce(F.col("_first") <= F.lag("_last").over(by_slice) + span, F.lit(False)))
    # where the session that is open at the end of a slice began, if it began in it
    began = F.when((F.col("_n") > 1) | ~F.col("_goes_on"), F.col("_newest"))
    slices = slices.withColumn("_began", began)
    open_ = F.last("_began", ignorenulls=True).over(by_slice.rowsBetween(Window.unboundedPreceding, -1))
    slices = slices.select("_of", F.when(F.col("_goes_on"), open_).alias("_open"))
    whole = islands.join(slices, F.col("_at") == F.col("_of"))
    start = F.when((F.col("_island") == 1) & F.col("_open").isNotNull(), F.col("_open")).otherwise(F.col("_from"))
    return whole.groupBy(F.col("_at.key").alias(key), start.alias("session_start")).agg(
        F.max("_to").alias("session_end"), F.sum("events").alias("events"), *[F.sum(n).alias(n) for n in measures]
    )
