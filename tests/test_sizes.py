"""What a task holds does not grow with the input: folds that run once, and the size of shuffle partitions."""

from __future__ import annotations

import re

from martlet.operators import scoring
from martlet.plans.catalog import QUERIES
from martlet.session import initial_partitions
from martlet.sources.registry import derived_sources
from tests.conftest import SF_DIR
from tests.test_plans import large, plan  # noqa: F401

SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_touches_are_folded_once_for_the_weights_of_an_order(large):  # noqa: F811
    text = plan(large, "time_decay_normalised")
    # one join brings the orders to their touches; a self-join for the sum of weights would work out the fold twice
    assert len(re.findall(r"SortMergeJoin \[order_id", text)) <= 1 and "Window [sum(_weight" in text


def test_lines_are_folded_once_for_their_categories(large):  # noqa: F811
    text = plan(large, "top_categories")
    # a map of (order, product) in the task that joins holds a group for nearly every line
    assert not re.search(r"Aggregate\(key=?s?=?\[[^\]]*product_id", text)
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*order_id", text)) == 3


def test_partitions_are_merged_to_what_a_task_can_hold(spark):
    before = spark.conf.get(SIZE, None)
    try:
        spark.conf.unset(SIZE)
        derived_sources(spark, SF_DIR)
        assert spark.conf.get(SIZE) == "16m"
        spark.conf.set(SIZE, "8m")
        derived_sources(spark, SF_DIR)
        assert spark.conf.get(SIZE) == "8m"
    finally:
        spark.conf.unset(SIZE) if before is None else spark.conf.set(SIZE, before)


def test_partitions_to_start_from_follow_the_input():
    assert initial_partitions(10**9) == 200
    for size in (10**11, 10**12, 3 * 10**12):
        assert size / initial_partitions(size) < 40e6
    assert initial_partitions(10**14) == 100_000


def test_lead_features_are_worked_out_once_for_routing(src, monkeypatch):
    made = []
    features = scoring.lead_features
    monkeypatch.setattr(scoring, "lead_features", lambda s: made.append(1) or features(s))
    monkeypatch.setattr(scoring, "PARAMS", {**scoring.PARAMS, "maxIter": 2})
    fresh = derived_sources(src.spark, SF_DIR)
    rows = QUERIES["routed_leads"](fresh).collect()
    assert len(made) == 1
    assert len(rows) == features(fresh).count() and all(r.routed_by_score for r in rows)
