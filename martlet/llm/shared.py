"""Small helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.session import scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written under ``spark.checkpoint.dir`` and read again, which cuts its lineage.

    A lost executor then costs a read of the file, and both uses of a frame see the same rows.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())
