"""References, table differences, JSON attributes and sketches on planted rows."""

from __future__ import annotations

import json
import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from martlet.operators.attributes import attribute_rows, malformed_rows, typed_attributes
from martlet.operators.integrity import check_references, missing_references, table_difference
from martlet.operators.sketches import daily_sketches, distinct_from_sketches


@pytest.fixture(scope="module")
def family(spark):
    """A third of the children refers to one parent that is not there; nulls on both sides."""
    child = spark.createDataFrame([(i, 99 if i % 3 == 0 else None if i % 7 == 0 else i % 20) for i in range(900)], "id int, up int")
    parent = spark.createDataFrame([(k,) for k in [None, 3, 3, *range(15)]], "key int")
    return child, parent


def test_missing_references(family):
    child, parent = family
    held = Counter(r.up for r in child.collect() if r.up is not None)
    wanted = {k: n for k, n in held.items() if k not in range(15)}
    assert wanted[99] == 300
    assert dict(missing_references(child, "up", parent, "key").collect()) == wanted


def test_report_counts_faults_and_empty_tables(family):
    child, parent = family
    none = child.filter("false")
    report = check_references(
        [("c", child, "up", "p", parent, "key"), ("none", none, "up", "p", parent, "key"), ("c", child, "up", "none", parent.filter("false"), "key")]
    ).collect()
    by_edge = {(r.child, r.parent): (r.missing_values, r.missing_rows) for r in report}
    ups = [r.up for r in child.collect() if r.up is not None]
    missing = [u for u in ups if u not in range(15)]
    assert by_edge == {("c", "p"): (len(set(missing)), len(missing)), ("none", "p"): (0, 0), ("c", "none"): (len(set(ups)), len(ups))}


def test_difference_is_of_bags(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, 1.5, 2.5])) for _ in range(500)] + [("hot", 0.0)] * 250
    changed = [*rows[1:], ("new", 1.0), ("new", 1.0)]
    rng.shuffle(changed)
    old, new = spark.createDataFrame(rows, "k string, v double"), spark.createDataFrame(changed, "k string, v double")
    a, b = Counter(rows), Counter(changed)
    wanted = {(k, v, a[k, v], b[k, v]) for k, v in a | b if a[k, v] != b[k, v]}
    assert {tuple(r) for r in table_difference(old, new.select("v", "k")).collect()} == wanted and len(wanted) == 2
    assert table_difference(old, old.orderBy("v")).isEmpty()
    assert table_difference(old.filter("false"), old.filter("false")).isEmpty()
    with pytest.raises(ValueError):
        table_difference(old, new.drop("v"))


TEXTS = ['{"k": 1, "s": "x y"}', '{"k": null}', "{}", "", None, "{bad", '[1, 2]', '"text"', '{"k": "no number", "o": {"p": [1]}}', '{"k": 2, "k.l": 3}']


@pytest.fixture(scope="module")
def bags(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, props string")


def test_attribute_rows(bags):
    found = {(r.id, r.name): r.value for r in attribute_rows(bags, ["id"], "props").collect()}
    assert json.loads(found.pop((8, "o"))) == {"p": [1]}
    assert found == {(0, "k"): "1", (0, "s"): "x y", (1, "k"): None, (8, "k"): "no number", (9, "k"): "2", (9, "k.l"): "3"}


def test_malformed_rows(bags):
    assert {r.id for r in malformed_rows(bags, ["id"], "props").collect()} == {3, 5, 6, 7}


def test_typed_attributes_read_only_what_is_used(bags):
    typed = typed_attributes(bags, "props", "k long, s string")
    assert {r.id: (r.k, r.s) for r in typed.collect() if r.k is not None} == {0: (1, "x y"), 9: (2, None)}
    assert typed.columns == ["id", "k", "s"] and typed.count() == len(TEXTS)
    assert "from_json(StructField(s" not in typed.select("k")._jdf.queryExecution().optimizedPlan().toString()


def test_sketches_merge_within_their_error(spark):
    """30 000 ids, each seen on several days: the merged estimate counts an id once."""
    day = F.expr("date_add(DATE '2024-01-01', CAST(id % 10 AS INT))")
    seen = spark.range(120_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise("other").alias("channel"), day.alias("day"),
        F.when(F.col("id") % 11 > 0, (F.col("id") * 7919) % 30_000).alias("person"),
    )
    sketches = daily_sketches(seen, ["channel"], "day", "person")
    for first, last in [(None, None), (date(2024, 1, 3), date(2024, 1, 5))]:
        part = seen if first is None else seen.filter(F.col("day").between(first, last))
        exact = dict(part.groupBy("channel").agg(F.countDistinct("person")).collect())
        got = dict(distinct_from_sketches(sketches, ["channel"], "day", first, last).collect())
        assert got.keys() == exact.keys()
        assert all(abs(got[c] - exact[c]) <= 0.05 * exact[c] for c in exact)
    late = date(2024, 1, 1) + timedelta(days=100)
    assert distinct_from_sketches(sketches, ["channel"], "day", late).isEmpty()
