"""Attributes kept as JSON text, read when they are asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _fields(column: str):
    return F.from_json(column, "map<string,string>")


def attribute_rows(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, name, value): one row for each top-level field of the JSON object in ``column``.

    Values are text, those of nested fields their JSON; a JSON null is null. Null, empty and malformed objects give no
    rows; ``malformed_rows`` lists the last. A narrow step: no shuffle, and only ``keys`` and ``column`` are read.
    """
    return df.select(*keys, F.explode(_fields(column)).alias("name", "value"))


def malformed_rows(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, column) of the rows whose text is no JSON object; a null is not malformed."""
    return df.filter(F.col(column).isNotNull() & _fields(column).isNull()).select(*keys, column)


def typed_attributes(df: DataFrame, column: str, schema: str) -> DataFrame:
    """``df`` with ``column`` replaced by the fields of ``schema``; a field that is missing or has another type is null.

    No field may have the name of a column of ``df``.
    """
    return df.withColumn(column, F.from_json(column, schema)).select("*", f"`{column}`.*").drop(column)
