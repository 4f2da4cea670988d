"""Routing of inbound leads: score each one as it arrives and alert on the high ones.

``route_leads`` is stateless: every lead is judged on its own, so there is no watermark and no state to keep.
``route_leads_once`` alerts once for a lead that comes again within some time, and its table keeps one alert per lead and day
whatever is repeated after a failure.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from martlet.operators.scoring import score_leads
from martlet.streaming.tables import BATCH, read_table, run_available, upsert_partitions


def lead_alerts(leads: DataFrame, model: PipelineModel, threshold: float = 0.8) -> DataFrame:
    """Alert rows for leads scored above the threshold; the same on a batch and on a stream."""
    return (
        score_leads(model, leads)
        .filter(F.col("score") > threshold)
        .select("contact_id", "email", "score", F.lit("Immediate follow-up required!").alias("action"))
    )


def route_leads(
    spark: SparkSession,
    inbox: str,
    schema: StructType,
    model: PipelineModel,
    alerts: str,
    checkpoint: str,
    threshold: float = 0.8,
    files_per_trigger: int = 100,
) -> DataFrame:
    """Scores every lead file not seen before, appends the alerts and returns the alert table.

    The checkpoint remembers which files are done, so a restart continues and the parquet sink
    writes each micro-batch once.
    """
    inbound = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(inbox)
    query = (
        lead_alerts(inbound, model, threshold)
        .writeStream.format("parquet")
        .option("path", alerts)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .outputMode("append")
        .start()
    )
    query.awaitTermination()
    written = lead_alerts(spark.createDataFrame([], schema), model, threshold).schema
    return spark.read.schema(written).parquet(alerts)


def route_leads_once(
    spark: SparkSession,
    inbox: str,
    schema: StructType,
    model: PipelineModel,
    alerts: str,
    checkpoint: str,
    time: str,
    within: str = "1 day",
    threshold: float = 0.8,
    files_per_trigger: int = 100,
) -> DataFrame:
    """As ``route_leads`` for leads with an event time, of which many may come more than once: (contact_id, email, score, action, day).

    A contact that comes again within ``within`` of its first row gives no second alert; the state holds the contacts of
    that time only, and leads later than that are dropped. Alerts are put into the table by contact and day, so a micro-batch that
    is repeated changes nothing and rewrites only its days.
    """
    inbound = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(inbox)
    first = inbound.withWatermark(time, within).dropDuplicatesWithinWatermark(["contact_id"])

    def put(batch: DataFrame, batch_id: int) -> None:
        days = batch.select("contact_id", F.to_date(time).alias("day")).dropDuplicates(["contact_id"])
        found = lead_alerts(batch.drop(time), model, threshold).join(days, "contact_id")
        upsert_partitions(found, batch_id, alerts, ["contact_id", "day"], ["day"])

    run_available(first.writeStream.outputMode("append"), put, checkpoint)
    kinds = lead_alerts(spark.createDataFrame([], schema).drop(time), model, threshold).schema
    written = StructType([*kinds.fields, StructField("day", DateType()), StructField(BATCH, LongType())])
    return read_table(spark, alerts, written).drop(BATCH)
