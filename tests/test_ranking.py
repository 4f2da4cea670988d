"""Positions are those of a plain window, whatever the sizes of the groups."""

from __future__ import annotations

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from martlet.operators.builders import assign_touch_credits
from martlet.operators.ranking import number_rows


def _positions(df):
    """Null order values stand before the others, as in a window."""
    return sorted((str(r.k), r.a is not None, r.a or 0, r.b, r.pos, r.n) for r in df.collect())


def test_hot_groups_rank_like_a_window(spark):
    rng = random.Random(7)
    data = [("hot" if i % 3 else f"k{i % 11}", rng.choice([None, 0, 1, 2, 3, 4, 5]), i) for i in range(3000)]
    data += [(None, 1, i) for i in range(500)]
    df = spark.createDataFrame(data, "k string, a int, b int").repartition(5)
    group = Window.partitionBy("k")
    plain = df.withColumn("pos", F.row_number().over(group.orderBy("a", "b"))).withColumn("n", F.count(F.lit(1)).over(group))
    assert _positions(plain) == _positions(number_rows(df, "k", ["a", "b"], "pos", "n"))


def test_coarse_slices(spark):
    df = spark.createDataFrame([(k, i) for k in "xy" for i in range(200)], "k string, i int")
    got = number_rows(df, "k", ["i"], "pos", slice_by=F.col("i") / 30).collect()
    assert all(r.pos == r.i + 1 for r in got) and len(got) == 400
    assert number_rows(df.limit(0), "k", ["i"], "pos").count() == 0


def test_credits_of_each_order_add_up(spark):
    df = spark.createDataFrame([(o, i) for o in range(1, 6) for i in range(o)], "order_id long, i int")
    got = assign_touch_credits(df, ["i"]).groupBy("order_id").agg(
        {"first_touch_credit": "sum", "last_touch_credit": "sum", "linear_credit": "sum"}
    )
    for r in got.collect():
        assert r["sum(first_touch_credit)"] == 1.0 and r["sum(last_touch_credit)"] == 1.0
        assert abs(r["sum(linear_credit)"] - 1.0) < 1e-3
