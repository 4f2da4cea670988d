"""Traffic metrics of event-time windows and sessions, as events arrive and over the same events in batch.

An event is late if it arrived more than ``delay`` after it happened. Late events are in no window; they go to a table of their own.
As files come in order of arrival, an event that is not late is never below the watermark (the latest time seen
before its batch, less the delay), so the stream's windows are those of the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from martlet.streaming.tables import read_table, run_available, upsert_partitions

#: columns that hits must have
HITS = "event_id long, customer_id string, event_type string, channel string, ts timestamp, value double, arrived timestamp"


def is_late(delay: str) -> Column:
    return F.col("arrived") > F.col("ts") + F.expr(f"INTERVAL {delay}")


def _cents(kind: str) -> Column:
    """Whole cents: their sums are the same in any order."""
    return F.sum(F.when(F.col("event_type") == kind, F.round(F.col("value") * 100)).cast("long"))


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_type") == "click").alias("clicks"),
        (F.coalesce(_cents("purchase"), F.lit(0)) / 100).alias("purchase_value"),
    ]


def window_metrics(hits: DataFrame, size: str, slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """(window_day, window_start, channel, events, clicks, purchase_value) of events in time, by window; the same for a stream."""
    in_time = hits.filter(~is_late(delay)).withWatermark("ts", delay)
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    counted = in_time.groupBy(window.alias("w"), "channel").agg(*_measures())
    return counted.select(
        F.to_date("w.start").alias("window_day"), F.col("w.start").alias("window_start"), "channel", "events", "clicks", "purchase_value"
    )


def late_counts(hits: DataFrame, delay: str = "1 hour") -> DataFrame:
    """(channel, late_events) of a batch of hits."""
    return hits.filter(is_late(delay)).groupBy("channel").agg(F.count(F.lit(1)).alias("late_events"))


def _inbox(spark: SparkSession, inbox: str, files_per_trigger: int) -> DataFrame:
    return spark.readStream.schema(HITS).option("maxFilesPerTrigger", files_per_trigger).parquet(inbox)


def run_window_metrics(
    spark: SparkSession, inbox: str, table: str, late: str, checkpoint: str, size: str, slide: str | None = None, delay: str = "1 hour", files_per_trigger: int = 100
) -> tuple[DataFrame, DataFrame]:
    """Brings the tables of windows and of late events up to what has arrived; returns both.

    Windows come in update mode and are put into the table by key, so it holds the unfinished ones too, and a micro-batch that is
    repeated after a failure changes nothing. State is kept for windows within the delay of the latest event only.
    """
    hits = _inbox(spark, inbox, files_per_trigger)
    keys = ["window_day", "window_start", "channel"]
    windows = window_metrics(hits, size, slide, delay)
    run_available(
        windows.writeStream.outputMode("update"), lambda df, i: upsert_partitions(df, i, table, keys, ["window_day"]), f"{checkpoint}/windows"
    )
    apart = hits.filter(is_late(delay)).withColumn("day", F.to_date("ts"))
    run_available(
        apart.writeStream.outputMode("append"), lambda df, i: upsert_partitions(df, i, late, ["event_id", "day"], ["day"]), f"{checkpoint}/late"
    )
    extra = StructType([StructField("_batch", LongType())])
    return (
        read_table(spark, table, StructType([*windows.schema.fields, *extra.fields])).drop("_batch"),
        read_table(spark, late, StructType([*apart.schema.fields, *extra.fields])).drop("_batch"),
    )


def session_stream(hits: DataFrame, gap: str, delay: str = "1 hour") -> DataFrame:
    """Sessions of a stream of hits, each when the watermark has passed its end: (customer_id, session_start, session_end, events, clicks).

    A row without customer_id moves the watermark and is in no session: send one after the last event to close what is open.
    """
    timed = hits.withWatermark("ts", delay).filter(~is_late(delay))
    keyed = timed.groupBy("customer_id", F.session_window("ts", gap).alias("w")).agg(
        F.max("ts").alias("session_end"),
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_type") == "click").alias("clicks"),
        F.count("customer_id").alias("named"),
    )
    # a filter on the key itself would be pushed below the watermark, and take from it the rows that are to move it
    return keyed.filter("named > 0").select("customer_id", F.col("w.start").alias("session_start"), "session_end", "events", "clicks")


def run_sessions(spark: SparkSession, inbox: str, table: str, checkpoint: str, gap: str, delay: str = "1 hour", files_per_trigger: int = 100) -> DataFrame:
    """Adds the sessions that are over to the table, by day of their start, and returns it."""
    sessions = session_stream(_inbox(spark, inbox, files_per_trigger), gap, delay).withColumn("day", F.to_date("session_start"))
    keys = ["customer_id", "session_start", "day"]
    run_available(sessions.writeStream.outputMode("append"), lambda df, i: upsert_partitions(df, i, table, keys, ["day"]), checkpoint)
    return read_table(spark, table, StructType([*sessions.schema.fields, StructField("_batch", LongType())])).drop("_batch")
