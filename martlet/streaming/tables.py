"""A parquet table that micro-batches write into, once each, partition by partition."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

BATCH = "_batch"


def _stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return spark.read.schema(schema).parquet(path)


def upsert_partitions(batch: DataFrame, batch_id: int, path: str, keys: list[str], partition_by: list[str], order_by: list[str] | None = None) -> None:
    """Puts the batch's rows into the table by key; only the partitions that it touches are read and written again.

    Of rows with one key the one of the greatest batch id stays, then the greatest by ``order_by``, then by all columns. So a batch that
    comes again changes nothing, whatever came after it. Null keys are equal to each other, and the keys must include the
    partition columns, which a row therefore never leaves. Writing replaces the files of a partition when the job commits; other
    partitions keep theirs. The table has one column more, the batch id of each row (``_batch``).
    """
    if missing := [c for c in partition_by if c not in keys]:
        raise ValueError(f"partition columns must be keys: {', '.join(missing)}")
    spark = batch.sparkSession
    incoming = batch.withColumn(BATCH, F.lit(batch_id).cast("long"))
    old = _stored(spark, path, StructType([*batch.schema.fields, StructField(BATCH, LongType())]))
    if old is not None:
        touched = batch.select(*[F.col(c).alias(f"_{c}") for c in partition_by]).distinct()
        same = F.lit(True)
        for c in partition_by:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        incoming = old.join(touched, same, "left_semi").select(*incoming.columns).unionByName(incoming)
    rest = [c for c in incoming.columns if c not in keys and c != BATCH]
    rank = F.struct(BATCH, *(order_by or []), *rest)
    merged = incoming.groupBy(*keys).agg(F.max_by(F.struct(BATCH, *rest), rank).alias("_row")).select(*keys, "_row.*")
    writer = merged.select(*[c for c in batch.columns if c not in partition_by], BATCH, *partition_by).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table's rows; none if nothing was written."""
    old = _stored(spark, path, schema)
    return spark.createDataFrame([], schema) if old is None else old


def run_available(writer: DataStreamWriter, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Runs a stream over all that has arrived, handing each micro-batch and its id to ``each``."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()
    query.awaitTermination()
    return query
