"""Reading, writing and inspecting tables."""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType


def read_csv_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header line, typed by the given schema; a malformed row fails the read."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path)
    )


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=()) -> DataFrame:
    """Write parquet (full refresh unless told otherwise) and return the table as stored."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def append(batch: DataFrame, path: str) -> DataFrame:
    """Insert without a key."""
    return write_table(batch, path, mode="append")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The target with the batch's rows put in by key; in the batch the last row by order wins.

    The batch may carry columns the target lacks (such as a version to order by); they are
    dropped at the end. ``max_by`` keeps one row per key in the map-side combine, so a key that repeats in the batch
    never gathers in one task. A target row stays unless its key is in the batch; null keys are equal to each other.
    """
    rest = [c for c in batch.columns if c not in keys]
    latest = (
        batch.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order_by)).alias("_row"))
        .select(*keys, "_row.*")
    )
    # each key as a pair of itself and whether it is there: a plain equality that null keys meet too
    whole = lambda name: F.struct(*[F.struct(F.col(k).isNull().alias("no"), F.col(k).alias("k")).alias(k) for k in keys]).alias(name)
    kept = target.select("*", whole("_key")).join(latest.select(whole("_in")), F.col("_key") == F.col("_in"), "left_anti").drop("_key")
    return kept.unionByName(latest.select(*target.columns))


def limit_rows(df: DataFrame, n: int, order_by: list) -> DataFrame:
    """The first n rows in the given order (a top-n, not a full sort)."""
    return df.orderBy(*order_by).limit(n)


def null_clean(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating-point column."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.select(
        *[
            F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) if c in floating else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def load_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in sorted(tables.items())
    ]
    return _union(counts)


def describe_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column: table, position, name, type, with the table's row and column counts."""
    parts = []
    for name, df in sorted(tables.items()):
        columns = F.array(
            *[
                F.struct(
                    F.lit(i).alias("column_position"),
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("column_type"),
                )
                for i, f in enumerate(df.schema.fields, 1)
            ]
        )
        parts.append(
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"),
                "row_count",
                F.lit(len(df.columns)).alias("column_count"),
                F.inline(columns),
            )
        )
    return _union(parts)


def preview(df: DataFrame, n: int, order_by: list) -> DataFrame:
    """The first n rows of a table in an order that makes them the same each time."""
    return limit_rows(df, n, order_by)


def run_sql(
    spark: SparkSession, sql: str, tables: dict[str, DataFrame], check: bool = False
) -> tuple[DataFrame | None, str | None]:
    """Ad-hoc read-only SQL over the given tables: (frame, None) or (None, error text).

    The frame is lazy; what is wrong with the statement itself comes back at once. With ``check`` it also runs once to a sink that keeps
    nothing, so that errors of its rows come back as text too. What could leave the engine (scripts, calls of Java methods) is
    refused by the analysed plan, whatever the text looks like.
    """
    if not re.match(r"(?is)^\s*(select|with)\b", sql):
        return None, "only SELECT or WITH statements are allowed"
    # A Spark statement may start with WITH or SELECT only to read; the one exception is a CTE
    # in front of INSERT, which the plan's output gives away.
    if re.search(r"(?is)\)\s*insert\s+(into|overwrite)\b", sql):
        return None, "only SELECT or WITH statements are allowed"
    try:
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
        frame = spark.sql(sql)
        plan = frame._jdf.queryExecution().analyzed().toString()
        if re.search(r"(?i)ScriptTransformation|\b(try_)?reflect\(|\bjava_method\(|CallMethodViaReflection", plan):
            return None, "scripts and Java methods are not allowed"
        if check:
            frame.write.format("noop").mode("overwrite").save()
        return frame, None
    except PySparkException as error:
        return None, str(error)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out
