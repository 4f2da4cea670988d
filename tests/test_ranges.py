"""Range joins against all pairs, and marts by increments against a full refresh."""

from __future__ import annotations

import random
from pathlib import Path

from pyspark.sql import functions as F

from martlet.operators.increments import high_water_mark, read_mart, refresh_changed_months
from martlet.operators.intervals import LIMIT, overlap_join, range_join


def _ranges(rng, n, spread):
    out = []
    for i in range(n):
        low = rng.choice([None, rng.randint(-spread, spread), 0])
        high = rng.choice([None, rng.randint(-spread, spread), (low or 0) + rng.randint(0, 40)])
        out.append((i, low, high))
    return out


def test_values_in_ranges(spark):
    rng = random.Random(7)
    ranges = _ranges(rng, 40, 3000) + [(100, -(10**15), 10**15), (101, 5, 5), (102, 9, 2), (103, 0, 1), (103, 0, 1)]
    # a third of the values are one value
    values = [rng.choice([None, 0, 0, rng.randint(-3500, 3500), rng.randint(-(10**15), 10**16)]) for _ in range(600)]
    points = spark.createDataFrame(list(enumerate(values)), "p int, v long")
    frame = spark.createDataFrame(ranges, "r int, low long, high long")
    got = sorted((x.p, x.r) for x in range_join(points, "v", frame, "low", "high").collect())
    lo, hi = lambda x: -LIMIT if x is None else x, lambda x: LIMIT if x is None else x
    assert got == sorted((p, r) for p, v in enumerate(values) if v is not None for r, a, b in ranges if lo(a) <= v < hi(b))
    assert range_join(points, "v", frame.filter("false"), "low", "high").isEmpty()
    assert range_join(points.filter("false"), "v", frame, "low", "high").isEmpty()


def test_ranges_that_overlap(spark):
    rng = random.Random(8)
    a, b = _ranges(rng, 45, 500), _ranges(rng, 45, 500)
    left, right = spark.createDataFrame(a, "l int, la long, lb long"), spark.createDataFrame(b, "r int, ra long, rb long")
    got = sorted((x.l, x.r) for x in overlap_join(left, right, "la", "lb", "ra", "rb").collect())
    ends = lambda rows: [(i, -LIMIT if x is None else x, LIMIT if y is None else y) for i, x, y in rows]
    assert got == sorted((i, j) for i, p, q in ends(a) for j, s, t in ends(b) if max(p, s) < min(q, t))


def _totals(src):
    return src.table("ads").groupBy("date").agg(F.sum("spend").alias("spend"), F.count(F.lit(1)).alias("n"))


def _files(path):
    return {str(f) for f in Path(path).rglob("*.parquet")}


def test_increments_touch_their_months_only(spark, tmp_path):
    path = str(tmp_path / "mart")
    loads = [
        [("2020-01-05", 1.0, 1), ("2020-02-07", 2.0, 1), (None, 9.0, 1)],
        [("2020-03-01", 4.0, 2)],
        [("2020-02-07", 8.0, 3), ("2020-02-09", 16.0, 3)],  # late
    ]
    seen, month = [], lambda m: _files(f"{path}/_month=2020-0{m}-01")
    for i, rows in enumerate(loads, 1):
        before = _files(path)
        seen += rows
        ads = spark.createDataFrame(seen, "date string, spend double, load_id long").withColumn("date", F.col("date").cast("date"))
        assert refresh_changed_months({"ads": ads}, _totals, path) == i == high_water_mark(spark, f"{path}_marks")
        touched = {m for m in (1, 2, 3) if month(m) - before}
        assert touched == [{1, 2}, {3}, {2}][i - 1]
        full = ads.filter("date IS NOT NULL").groupBy("date").agg(F.sum("spend").alias("spend"), F.count(F.lit(1)).alias("n"))
        assert sorted(read_mart(spark, path).select("date", "spend", "n").collect()) == sorted(full.collect())
    before = _files(path)
    assert refresh_changed_months({"ads": ads}, _totals, path) == 3 and _files(path) == before


def test_nothing_to_take_in(spark, tmp_path):
    empty = spark.createDataFrame([], "date date, spend double, load_id long")
    assert refresh_changed_months({"ads": empty}, _totals, str(tmp_path / "none")) is None
