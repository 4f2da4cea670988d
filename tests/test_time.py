"""As-of joins, sessions, streaming windows and the table they write, against plain Python."""

from __future__ import annotations

import os
import random
import shutil
from bisect import bisect_right
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from martlet.operators.asof import asof_join
from martlet.operators.sessions import gap_sessions
from martlet.plans.metrics import query_metric
from martlet.sources import io
from martlet.streaming import traffic
from martlet.streaming.routing import lead_alerts, route_leads_once
from martlet.streaming.tables import upsert_partitions

T0 = datetime(2024, 3, 1)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


@pytest.fixture(scope="module")
def moments():
    """A third of the rows on one key, ties, null keys and null times."""
    rng = random.Random(11)
    key = lambda i: "hot" if i % 3 == 0 else rng.choice([None, "a", "b", "c", "never"])
    left = [(i, key(i), None if i % 50 == 0 else at(rng.randrange(8000))) for i in range(2000)]
    right = [(None if i % 40 == 0 else key(i), None if i % 45 == 0 else at(rng.randrange(8000)), rng.choice("xyz"), i) for i in range(600)]
    return left, [r for r in right if r[0] != "never"]


@pytest.mark.parametrize("unit", ["hour", "day", "year"])
def test_asof_join(spark, moments, unit):
    left, right = moments
    states = {}
    for k, t, state, n in right:
        if k is not None and t is not None:
            states.setdefault(k, {})
            states[k][t] = max(states[k].get(t, ("", -1)), (state, n))
    expected = []
    for i, k, t in left:
        times = sorted(states.get(k, {}))
        j = bisect_right(times, t) if t is not None else 0
        expected.append((i, k, t, *(states[k][times[j - 1]] if j else (None, None))))
    a = spark.createDataFrame(left, "i int, k string, t timestamp").repartition(4)
    b = spark.createDataFrame(right, "k string, u timestamp, state string, n int").repartition(3)
    got = asof_join(a, b, ["k"], "t", "u", ["state", "n"], unit)
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in got.collect())
    assert asof_join(a.limit(0), b, ["k"], "t", "u", ["n"]).count() == 0
    assert {r.n for r in asof_join(a, b.limit(0), ["k"], "t", "u", ["n"]).collect()} == {None}


def test_asof_join_forms_no_pairs(spark, moments):
    left, right = moments
    a = spark.createDataFrame(left, "i int, k string, t timestamp")
    b = spark.createDataFrame(right, "k string, u timestamp, state string, n int")
    plan = asof_join(a, b, ["k"], "t", "u", ["n"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "(_at" in plan and ">=" not in plan


def plain_sessions(rows, gap):
    by_key = {}
    for k, t in rows:
        if k is not None and t is not None:
            by_key.setdefault(k, []).append(t)
    out = []
    for k, times in by_key.items():
        times.sort()
        start = prior = times[0]
        n = 0
        for t in times:
            if t > prior + gap:
                out.append((k, start, prior, n))
                start, n = t, 0
            n, prior = n + 1, t
        out.append((k, start, prior, n))
    return sorted(out)


@pytest.mark.parametrize("unit", ["minute", "hour", "day", "year"])
def test_sessions_across_slices(spark, unit):
    rng = random.Random(2)
    rows = [("hot" if i % 3 else rng.choice(["a", "b", None]), rng.choice([None, *[at(rng.randrange(9000))] * 20])) for i in range(1500)]
    rows += [("chain", at(30 * i)) for i in range(200)] + [("apart", at(31 * i)) for i in range(50)] + [("one", at(7)), ("one", at(7))]
    df = spark.createDataFrame(rows, "k string, t timestamp").repartition(4)
    got = gap_sessions(df, "k", "t", "30 minutes", {"double_events": F.lit(2)}, unit)
    assert plain_sessions(rows, timedelta(minutes=30)) == sorted(tuple(r)[:4] for r in got.collect())
    assert got.filter("double_events <> 2 * events").count() == 0
    assert gap_sessions(df.limit(0), "k", "t", "30 minutes", {}).count() == 0


def hits_of(rows):
    return [(i, u, kind, ch, t, v, t + timedelta(minutes=late)) for i, (u, kind, ch, t, v, late) in enumerate(rows)]


@pytest.fixture(scope="module")
def arriving(spark, tmp_path_factory):
    """Five files in order of arrival; a tenth of the events are two hours late."""
    rng = random.Random(4)
    rows = hits_of(
        [
            (rng.choice(["u1", "u1", "u2", "u3"]), rng.choice(["click", "purchase", "view"]), rng.choice(["x", "y", None]), at(3 * i + rng.random()), rng.choice([1.25, None, 3.1]), rng.choice([0.1] * 9 + [120]))
            for i in range(900)
        ]
    )
    rows.sort(key=lambda r: r[6])
    base = str(tmp_path_factory.mktemp("arriving"))
    for n in range(5):
        part = rows[n * 180 : (n + 1) * 180]
        spark.createDataFrame(part, traffic.HITS).coalesce(1).write.mode("append").parquet(f"{base}/all/{n}")
    return base, rows


def add_file(base, inbox, n):
    os.makedirs(inbox, exist_ok=True)
    for p in Path(f"{base}/all/{n}").glob("*.parquet"):
        shutil.copyfile(p, f"{inbox}/{n}-{p.name}")


@pytest.mark.parametrize("slide", [None, "30 minutes"])
def test_streamed_windows_equal_the_batch(spark, arriving, tmp_path, slide):
    base, rows = arriving
    inbox = f"{tmp_path}/inbox"

    def run():
        return traffic.run_window_metrics(spark, inbox, f"{tmp_path}/windows", f"{tmp_path}/late", f"{tmp_path}/checkpoint", "1 hour", slide, files_per_trigger=1)

    for n in (0, 1, 2):  # files one by one, the stream stopped and started again in between
        add_file(base, inbox, n)
        if n:
            run()
    add_file(base, inbox, 3)
    add_file(base, inbox, 4)
    windows, late = run()
    batch = spark.read.schema(traffic.HITS).parquet(inbox)
    expected = traffic.window_metrics(batch, "1 hour", slide)
    names = expected.columns
    assert sorted(map(str, windows.select(names).collect())) == sorted(map(str, expected.collect()))
    in_windows = windows.agg(F.sum("events")).first()[0]
    n_late = sum(r[6] > r[4] + timedelta(hours=1) for r in rows)
    assert late.count() == n_late > 50 and in_windows == (len(rows) - n_late) * (2 if slide else 1)
    assert {r.channel: r.late_events for r in traffic.late_counts(batch).collect()} == {r.channel: r["count"] for r in late.groupBy("channel").count().collect()}


def test_streamed_sessions_equal_the_batch(spark, arriving, tmp_path):
    base, rows = arriving
    inbox = f"{tmp_path}/inbox"

    def run():
        return traffic.run_sessions(spark, inbox, f"{tmp_path}/sessions", f"{tmp_path}/checkpoint", "20 minutes", files_per_trigger=1)

    for n in range(5):
        add_file(base, inbox, n)
        got = run()
    closed = got.count()
    end = at(10**6)
    spark.createDataFrame([(None, None, None, None, end, None, end)], traffic.HITS).coalesce(1).write.mode("append").parquet(inbox)
    got = run()
    in_time = [(r[1], r[4]) for r in rows if r[6] <= r[4] + timedelta(hours=1)]
    plain = plain_sessions(in_time, timedelta(minutes=20))
    assert plain == sorted((r.customer_id, r.session_start, r.session_end, r.events) for r in got.collect()) and 0 < closed < len(plain)
    batch = gap_sessions(spark.createDataFrame(in_time, "customer_id string, ts timestamp"), "customer_id", "ts", "20 minutes", {}, "hour")
    assert plain == sorted(tuple(r) for r in batch.collect())


def files_of(path):
    return {p.parent.name: sorted(q.name for q in p.parent.glob("*.parquet")) for p in Path(path).glob("*/*.parquet")}


def test_upserts_touch_only_their_partitions(spark, tmp_path):
    path = str(tmp_path / "table")
    kind = "day string, k int, v string"

    def put(rows, batch_id):
        upsert_partitions(spark.createDataFrame(rows, kind), batch_id, path, ["day", "k"], ["day"], ["v"])

    def table():
        return sorted((str(r.day), str(r.k), r.v) for r in spark.read.parquet(path).collect())

    put([("d1", 1, "a"), ("d1", None, "n"), ("d2", 1, "b"), (None, 3, "c"), ("d1", 1, "A")], 0)
    assert table() == [("None", "3", "c"), ("d1", "1", "a"), ("d1", "None", "n"), ("d2", "1", "b")]
    before = files_of(path)
    second = [("d1", 1, "z"), ("d1", None, "m"), ("d1", 7, "new")]
    put(second, 1)
    after = files_of(path)
    assert {d for d in before if before[d] != after[d]} == {"day=d1"}
    state = [("None", "3", "c"), ("d1", "1", "z"), ("d1", "7", "new"), ("d1", "None", "m"), ("d2", "1", "b")]
    assert table() == state
    put(second, 1)  # the batch comes again
    put([("d1", 1, "a"), ("d2", 1, "b")], 0)  # and so does an older one
    assert table() == state
    put([], 2)
    assert table() == state
    with pytest.raises(ValueError, match="must be keys"):
        upsert_partitions(spark.createDataFrame([], kind), 0, path, ["k"], ["day"])


def test_upsert_meets_null_keys(spark):
    target = spark.createDataFrame([(None, "x", 1), ("a", None, 2), ("a", "x", 3)], "k string, l string, v int")
    batch = spark.createDataFrame([(None, "x", 9, 1), ("a", None, 8, 1), (None, None, 7, 1)], "k string, l string, v int, version int")
    once = io.upsert(target, batch, ["k", "l"], ["version"])
    expected = {(None, "x", 9), ("a", None, 8), ("a", "x", 3), (None, None, 7)}
    assert {tuple(r) for r in once.collect()} == expected
    assert sorted(map(str, io.upsert(once, batch, ["k", "l"], ["version"]).collect())) == sorted(map(str, once.collect()))


def test_a_lead_that_comes_again_alerts_once(spark, src, tmp_path):
    from martlet.operators import scoring

    leads = scoring.lead_features(src).drop("is_won")
    model = scoring.train_lead_model(scoring.lead_features(src), maxIter=2)
    timed = leads.withColumn("arrived", F.lit(at(0)))
    timed.coalesce(1).write.parquet(f"{tmp_path}/inbox/a")
    timed.withColumn("arrived", F.lit(at(60))).unionByName(timed).coalesce(1).write.parquet(f"{tmp_path}/inbox/b")
    args = (spark, f"{tmp_path}/inbox/*", timed.schema, model, f"{tmp_path}/alerts", f"{tmp_path}/checkpoint", "arrived")
    got = route_leads_once(*args, threshold=0.5, files_per_trigger=1)
    expected = sorted(r.contact_id for r in lead_alerts(leads, model, 0.5).collect())
    assert sorted(r.contact_id for r in got.collect()) == expected and expected
    assert route_leads_once(*args, threshold=0.5).count() == len(expected)


def test_totals_tell_nulls_from_totals(spark, src):
    df = query_metric(src, ["total_deals", "win_rate"], group_by=["source"], grain="year", totals=True)
    rows = df.collect()
    assert {r.level for r in rows} == {0, 1, 3}
    years = {r.metric_time for r in rows if r.level == 1}
    assert None in years  # open deals have no close date; their year is a group, not a total
    whole = [r for r in rows if r.level == 3]
    assert len(whole) == 1 and whole[0].total_deals == sum(r.total_deals for r in rows if r.level == 1)
    both = query_metric(src, ["total_spend", "total_sessions", "cost_per_session"], grain="month", totals=True)
    top = both.filter("level = 1").first()
    plain = query_metric(src, ["total_spend", "total_sessions", "cost_per_session"]).first()
    assert (top.total_spend, top.total_sessions, top.cost_per_session) == tuple(plain)
    with pytest.raises(ValueError, match="rollup or cube"):
        query_metric(src, ["total_deals"], totals="all")


def test_totals_expand_a_model_once(spark, src):
    df = query_metric(src, ["total_deals", "total_pipeline_value"], group_by=["source", "stage"], totals="cube")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand ") == 1
