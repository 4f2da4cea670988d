"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.shared import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each node's larger neighbours to the smallest node next to it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return both.join(least, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    moved = down.join(least, F.col("a") == F.col("u")).filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node that it reaches.

    Each pass is written out, so a pass starts from a file; the number of passes grows with the logarithm of the
    number of nodes. Only a checksum of the links comes to the driver.
    """
    mark = lambda df: df.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
    edges = stored(links.select("a", "b").filter("a <> b").distinct(), "links")
    before = mark(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges).distinct()).distinct(), "links")
        after = mark(edges)
        if after == before:
            break
        before = after
    # now every node but the smallest of its component has one link, to the smallest
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
