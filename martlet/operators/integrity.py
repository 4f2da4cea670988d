"""Checks between tables: references without a target, and what changed between two loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.frames import union_all


def missing_references(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """(reference, rows): the values of ``column`` that no row of ``parent`` has as ``key``, with the child rows that hold them.

    Child rows are counted by value before they meet the parent, so a value with most of the rows is one row in the join.
    A null refers to nothing and is not missing.
    """
    held = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("reference")).agg(F.count(F.lit(1)).alias("rows"))
    targets = parent.select(F.col(key).alias("reference")).distinct()
    return held.join(targets, "reference", "left_anti")


def check_references(edges: list[tuple[str, DataFrame, str, str, DataFrame, str]]) -> DataFrame:
    """One report row for each edge (child name, child, column, parent name, parent, key)."""
    return union_all(
        missing_references(child, column, parent, key)
        .agg(F.count(F.lit(1)).alias("missing_values"), F.coalesce(F.sum("rows"), F.lit(0)).alias("missing_rows"))
        .select(
            F.lit(child_name).alias("child"), F.lit(column).alias("column"), F.lit(parent_name).alias("parent"),
            "missing_values", "missing_rows",
        )
        for child_name, child, column, parent_name, parent, key in edges
    )


def table_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """The rows that two loads hold in different numbers, with ``old_copies`` and ``new_copies``; empty if they are equal.

    Tables are bags: order does not matter, repeats and nulls do. It is one aggregate over both loads, combined before
    its shuffle, so a row repeated a million times is shuffled once a task. Columns are matched by name; maps can't be compared.
    """
    if set(old.columns) != set(new.columns):
        raise ValueError(f"columns differ: {sorted(set(old.columns) ^ set(new.columns))}")
    both = old.withColumns({"old_copies": F.lit(1), "new_copies": F.lit(0)}).unionByName(
        new.withColumns({"old_copies": F.lit(0), "new_copies": F.lit(1)})
    )
    counted = both.groupBy(*[f"`{c}`" for c in old.columns]).agg(
        F.sum("old_copies").alias("old_copies"), F.sum("new_copies").alias("new_copies")
    )
    return counted.filter(F.col("old_copies") != F.col("new_copies"))
