"""Marts by day kept up to date: only the months that a load touches are computed and written again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions.frames import union_all
from martlet.sources.io import append
from martlet.sources.registry import Sources

MONTH = "_month"


def high_water_mark(spark: SparkSession, marks: str) -> int | None:
    """The greatest load id that was taken in; None before the first."""
    try:
        return spark.read.schema("load_id long").parquet(marks).agg(F.max("load_id")).first()[0]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _month(day: str):
    return F.date_trunc("month", day).cast("date")


def refresh_changed_months(
    tables: dict[str, DataFrame], mart: Callable[[Sources], DataFrame], path: str, day: str = "date", load_id: str = "load_id"
) -> int | None:
    """Takes the rows above the high-water mark into the stored mart; returns the new mark.

    ``tables`` are the sources of the mart, all with a ``day`` and the id of the load that brought the row. Rows of new loads, late ones too, tell the
    touched months; the sources are cut to these months by a semi-join with one row a month, and their partitions of the mart
    are replaced. Other months are neither computed nor written: their files stay. It holds for marts whose rows depend on rows of
    their own day. The mark is written after the mart, so a refresh that died is done again, with the same result. Without new rows
    nothing is written. Rows whose day is null belong to no day and are left out.
    """
    spark = next(iter(tables.values())).sparkSession
    mark = high_water_mark(spark, f"{path}_marks")
    new = lambda df: df if mark is None else df.filter(F.col(load_id) > mark)
    fresh = union_all([new(df).groupBy(_month(day).alias(MONTH)).agg(F.max(load_id).alias("last")) for df in tables.values()])
    touched = fresh.filter(F.col(MONTH).isNotNull()).groupBy(MONTH).agg(F.max("last").alias("last"))
    latest = touched.agg(F.max("last")).first()[0]
    if latest is None:
        return mark
    months = touched.select(F.col(MONTH).alias("_touched"))

    def cut(name: str) -> DataFrame:
        rows = tables[name].filter(F.col(load_id) <= latest)
        return rows.join(months, _month(day) == F.col("_touched"), "left_semi").drop(load_id)

    rows = mart(Sources(spark, cut)).withColumn(MONTH, _month(day))
    writer = rows.repartition(MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(MONTH).parquet(path)
    append(spark.range(1).select(F.lit(latest).cast("long").alias("load_id")), f"{path}_marks")
    return latest


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(MONTH)
