"""Lead scoring, batch and stream, and the data checks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martlet.operators import quality, scoring
from martlet.streaming.routing import lead_alerts, route_leads
from tests.conftest import rows


@pytest.fixture(scope="module")
def leads(spark):
    """Leads whose label follows from their activity."""
    i = F.col("id")
    return spark.range(600).select(
        F.concat(F.lit("L"), i.cast("string")).alias("contact_id"),
        F.concat(F.lit("l"), i.cast("string"), F.lit("@example.com")).alias("email"),
        F.element_at(F.array(F.lit("Direct"), F.lit("Organic Search"), F.lit("Email")), (i % 3 + 1).cast("int")).alias("channel"),
        (i % 10 + 1).alias("sessions"),
        (i % 7).alias("engaged_sessions"),
        (i % 13).alias("page_views"),
        (i % 10 == 0).cast("int").alias("is_first_visit"),
        (i % 10 >= 5).cast("int").alias("is_won"),
    )


@pytest.fixture(scope="module")
def model(leads):
    return scoring.train_lead_model(leads, maxIter=5)


def test_training_learns_and_ignores_row_order(leads, model):
    again = scoring.train_lead_model(leads.orderBy(F.col("contact_id").desc()), maxIter=5)
    result = {r.metric: r.value for r in scoring.evaluate(model, leads).collect()}
    assert result["accuracy"] == 1.0 and result["auc"] == 1.0 and result["f1"] == 1.0
    assert rows(scoring.score_leads(model, leads), "contact_id", "score") == rows(
        scoring.score_leads(again, leads), "contact_id", "score"
    )


def test_boost_is_clipped(spark):
    p = spark.createDataFrame([(0.9, "Direct"), (0.5, "Organic Search"), (0.5, "Email"), (0.5, None)], "p double, c string")
    got = [r.s for r in p.select(scoring.boosted_score(F.col("p"), F.col("c")).alias("s")).collect()]
    assert got == [1.0, 0.55, 0.5, 0.5]


def test_rule_score_bounds(spark):
    score = lambda *a: spark.range(1).select(scoring.rule_score(*[F.lit(x) for x in a]).alias("s")).first().s
    assert score("Premium", "paid_search", 50, 1e9) == 0.97
    assert score("none", "none", 0, 0.0) == pytest.approx(0.25)
    tier = lambda v: spark.range(1).select(scoring.rule_tier(F.lit(v)).alias("t")).first().t
    assert [tier(v) for v in (0.6, 0.59, 0.35, 0.34)] == ["High value", "Medium value", "Medium value", "Low value"]


def test_split_is_stable_and_about_a_fifth(leads):
    parted = scoring.split(leads)
    share = parted.filter("is_test").count() / 600
    assert 0.12 < share < 0.28
    assert rows(parted, "contact_id", "is_test") == rows(scoring.split(leads.repartition(7)), "contact_id", "is_test")


def test_saved_model_scores_the_same(leads, model, tmp_path):
    scoring.save_model(model, str(tmp_path / "m"))
    loaded = scoring.load_model(str(tmp_path / "m"))
    assert rows(scoring.score_leads(loaded, leads), "contact_id", "score") == rows(
        scoring.score_leads(model, leads), "contact_id", "score"
    )


def test_run_log_appends(spark, leads, model, tmp_path):
    result = scoring.evaluate(model, leads)
    scoring.run_log(spark, str(tmp_path / "log"), "a", scoring.PARAMS, result)
    log = scoring.run_log(spark, str(tmp_path / "log"), "b", scoring.PARAMS, result)
    assert {r.run_id for r in log.collect()} == {"a", "b"}
    assert log.first().params["maxDepth"] == "5" and set(log.first().metrics) == {
        "accuracy", "precision", "recall", "f1", "auc",
    }


def test_stream_routes_like_the_batch_and_continues(spark, leads, model, tmp_path):
    inbound = leads.drop("is_won")
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("inbox", "alerts", "checkpoint"))
    early, late = inbound.filter("sessions <= 6"), inbound.filter("sessions > 6")
    early.repartition(3).write.parquet(inbox)
    route = lambda: route_leads(spark, inbox, inbound.schema, model, out, checkpoint, 0.5, files_per_trigger=1)
    assert rows(route()) == rows(lead_alerts(early, model, 0.5))
    late.repartition(2).write.mode("append").parquet(inbox)
    want = rows(lead_alerts(inbound, model, 0.5))
    assert rows(route()) == want and len(want) > 0
    assert route().count() == len(want)


def test_checks_find_planted_faults(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", "y"), (None, "x"), (None, "z"), ("b", None)], "id string, kind string"
    )
    checks = quality.Checks(("id",), ("id", "kind"), {"kind": ["x", "y"]})
    got = rows(quality.check_table(df, "t", checks))
    assert got == {
        ("t", "id", "not_null", 2, False), ("t", "kind", "not_null", 1, False),
        ("t", "kind", "accepted_values", 1, False), ("t", "id", "unique", 1, False),
    }
    assert quality.check_not_null(df, "id").count() == 2
    assert rows(quality.check_unique(df, "id")) == {("a", 2)}
    assert rows(quality.check_accepted_values(df, "kind", ["x", "y"])) == {("z", 1)}


def test_declared_assertions():
    suites = [*quality.STAGING_CHECKS.values(), *quality.MART_CHECKS.values()]
    assert sum(len(c.unique) for c in suites) == 15
    assert sum(len(c.not_null) for c in suites) == 58
    assert sum(len(c.accepted) for c in suites) == 6


def test_stream_without_leads_gives_an_empty_alert_table(spark, leads, model, tmp_path):
    inbound = leads.drop("is_won")
    inbound.limit(0).write.parquet(str(tmp_path / "inbox"))
    got = route_leads(
        spark, str(tmp_path / "inbox"), inbound.schema, model, str(tmp_path / "alerts"), str(tmp_path / "checkpoint")
    )
    assert got.columns == ["contact_id", "email", "score", "action"] and got.count() == 0


def test_auc_is_exact(spark, leads, model):
    """Against all pairs of a won and a lost lead, ties counting half."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(leads).select(vector_to_array("probability")[1].alias("p"), "is_won").collect()
    won, lost = [r.p for r in scored if r.is_won == 1], [r.p for r in scored if r.is_won == 0]
    right = sum((a > b) + (a == b) / 2 for a in won for b in lost)
    got = {r.metric: r.value for r in scoring.evaluate(model, leads).collect()}
    assert abs(got["auc"] - right / (len(won) * len(lost))) < 1e-6
    said = [(r.p > 0.5, r.is_won == 1) for r in scored]
    assert abs(got["accuracy"] - sum(a == b for a, b in said) / len(said)) < 1e-6
