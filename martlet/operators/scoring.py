"""Lead features, model training, evaluation, scoring, and the rule-based score."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlet.functions.metrics import lead_recommendation, lead_tier
from martlet.functions.numeric import count_if, half_up, ratio
from martlet.operators.marts import fct_lead_scoring_features
from martlet.operators.staging import stg_customers, stg_hubspot_contacts, stg_hubspot_deals, stg_orders
from martlet.session import ensure_checkpoint_dir
from martlet.sources.io import append
from martlet.sources.registry import Sources

FEATURES = ["sessions", "engaged_sessions", "page_views", "is_first_visit"]

# Training parameters.
PARAMS = {"maxDepth": 5, "stepSize": 0.1, "maxIter": 100, "seed": 42}

# of folded leads while a model is trained
ROWS_PER_PARTITION = 100_000

# Boost per channel, and the parts of the rule score.
CHANNEL_BOOST = {"Direct": 1.2, "Organic Search": 1.1}
SEGMENT_POINTS = {"Premium": 0.25, "Standard": 0.15, "Economy": 0.05}
SOURCE_POINTS = {
    "paid_search": 0.12,
    "email": 0.10,
    "referral": 0.08,
    "organic": 0.06,
    "social": 0.04,
    "direct": 0.03,
}


def _points(points: dict[str, float], key: Column, otherwise: float) -> Column:
    lookup = F.create_map(*[F.lit(x) for kv in points.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, key), F.lit(otherwise))


def lead_features(src: Sources) -> DataFrame:
    """One row per contact: web activity by person, and whether the latest deal was won.

    A session is a day with events. Events are folded to (person, day) before they are folded to
    the person, and contacts, activity and deals are joined on keys.
    """
    kind = F.col("event_type")
    daily = (
        src.table("web_events")
        .groupBy("customer_id", "event_date")
        .agg(
            F.max(kind.isin("click", "purchase").cast("int")).alias("engaged"),
            count_if(kind == "view").alias("views"),
        )
    )
    activity = daily.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("engaged").alias("engaged_sessions"),
        F.sum("views").alias("page_views"),
    )
    people = src.model(stg_customers).select("customer_id", "customer_unique_id")
    latest = (
        src.model(stg_hubspot_deals)
        .select("order_id", "deal_id", "deal_stage", "create_date")
        .join(src.model(stg_orders).select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id")
        .agg(F.max_by(F.struct("create_date", "deal_id", "deal_stage"), F.struct("create_date", "deal_id")).alias("_d"))
        .join(people, "customer_id")
        .groupBy(F.col("customer_unique_id").alias("customer_id"))
        .agg(F.max_by("_d.deal_stage", F.struct("_d.create_date", "_d.deal_id")).alias("last_stage"))
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    return (
        src.model(stg_hubspot_contacts)
        .select("contact_id", "customer_id", "email", "lead_source")
        .join(activity, "customer_id", "left")
        .join(latest, "customer_id", "left")
        .select(
            "contact_id",
            "email",
            F.initcap(F.translate("lead_source", "_", " ")).alias("channel"),
            zero("sessions").alias("sessions"),
            zero("engaged_sessions").alias("engaged_sessions"),
            zero("page_views").alias("page_views"),
            (zero("sessions") <= 1).cast("int").alias("is_first_visit"),
            F.coalesce((F.col("last_stage") == "closed_won").cast("int"), F.lit(0)).alias("is_won"),
        )
    )


def split(df: DataFrame, key: str = "contact_id", test: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test`` from a hash of the key: the same rows on every run and cluster."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 1000
    return df.withColumn("is_test", bucket < int(round(test * 1000)))


def train_lead_model(train: DataFrame, **params) -> PipelineModel:
    """Gradient-boosted trees on the four activity features.

    Leads with the same features and label are folded into one weighted row: the loss is the
    same, and the rows the trees iterate over are bounded by the distinct combinations of a few
    small counts, not by the number of leads.
    """
    folded = train.groupBy(*FEATURES, "is_won").agg(F.count(F.lit(1)).cast("double").alias("_weight"))
    settings = {**PARAMS, **params}
    # a checkpoint every tenth tree keeps the lineage short; few trees need none
    if settings["maxIter"] > 20:
        ensure_checkpoint_dir(train.sparkSession)
    stages = [
        VectorAssembler(inputCols=FEATURES, outputCol="features"),
        GBTClassifier(labelCol="is_won", weightCol="_weight", checkpointInterval=10, **settings),
    ]
    folded = folded.persist()
    try:
        # the trees run several jobs a round: few rows in many partitions would only cost tasks
        parts = max(1, -(-folded.count() // ROWS_PER_PARTITION))
        return Pipeline(stages=stages).fit(folded.coalesce(parts))
    finally:
        folded.unpersist()


def evaluate(model: PipelineModel, test: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 at 0.5 and AUC on held-out rows, as (metric, value)."""
    folded = test.groupBy(*FEATURES, "is_won").agg(F.count(F.lit(1)).alias("_n"))
    scored = model.transform(folded).withColumn("_score", vector_to_array("probability")[1])
    of = lambda cond: F.sum(F.when(cond, F.col("_n")).otherwise(0))
    said, was = F.col("prediction") == 1, F.col("is_won") == 1
    # one row per distinct score, bounded by the combinations of a few small counts
    by_score = scored.groupBy("_score").agg(
        of(was).alias("_won"), of(~was).alias("_lost"), of(said & was).alias("_tp"), of(said & ~was).alias("_fp")
    )
    # what lies below a score: whole ranges of a thousandth (a row each, so a bounded list), and the scores of its own range
    by_score = by_score.withColumn("_range", F.floor(F.col("_score") * 1000))
    ranges = by_score.groupBy("_range").agg(F.sum("_lost").alias("lost")).agg(F.collect_list(F.struct("_range", "lost"))).scalar()
    lower = F.aggregate(F.filter("_ranges", lambda x: x["_range"] < F.col("_range")), F.lit(0).cast("long"), lambda n, x: n + x["lost"])
    below = Window.partitionBy("_range").orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = by_score.withColumn("_ranges", ranges).withColumn("_below", lower + F.coalesce(F.sum("_lost").over(below), F.lit(0)))
    won, lost, tp, fp = (F.sum(c) for c in ("_won", "_lost", "_tp", "_fp"))
    # pairs of a won and a lost lead in the right order, ties counting half
    right = F.sum(F.col("_won") * (2 * F.col("_below") + F.col("_lost")))
    values = {
        "accuracy": ratio(tp + lost - fp, won + lost),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, won),
        "f1": ratio(2 * tp, tp + fp + won),
        "auc": ratio(right, 2 * won * lost),
    }
    rows = [F.struct(F.lit(n).alias("metric"), half_up(v, 6).alias("value")) for n, v in values.items()]
    return ranked.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))


def boosted_score(probability: Column, channel: Column) -> Column:
    """The model's probability, raised for some channels and kept within 0 and 1."""
    score = probability * _points(CHANNEL_BOOST, channel, 1.0)
    return F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))


def with_tier(df: DataFrame) -> DataFrame:
    score = F.col("score")
    return df.withColumns({"lead_tier": lead_tier(score), "recommendation": lead_recommendation(score)})


def score_leads(model: PipelineModel, leads: DataFrame) -> DataFrame:
    """Leads with score, tier and recommendation; works on a batch and on a stream."""
    probability = vector_to_array("probability")[1]
    scored = model.transform(leads).withColumn("score", boosted_score(probability, F.col("channel")))
    return with_tier(scored.drop("features", "rawPrediction", "probability", "prediction"))


def rule_score(segment: Column, source: Column, orders: Column, ltv: Column) -> Column:
    points = (
        F.lit(0.10)
        + _points(SEGMENT_POINTS, segment, 0.10)
        + _points(SOURCE_POINTS, source, 0.05)
        + F.least(orders * F.lit(0.08), F.lit(0.40))
        + F.least(ltv / 10000 * F.lit(0.20), F.lit(0.20))
    )
    return F.least(points, F.lit(0.97))


def rule_tier(score: Column) -> Column:
    return F.when(score >= 0.6, "High value").when(score >= 0.35, "Medium value").otherwise("Low value")


def rule_scored_leads(src: Sources) -> DataFrame:
    """The rule score of every customer; segments and sources are mapped to the rule's names."""
    segment = (
        F.when(F.col("customer_segment") == "vip", "Premium")
        .when(F.col("customer_segment") == "returning", "Standard")
        .otherwise("Economy")
    )
    source = F.regexp_replace("lead_source", "^(organic|paid_social).*$", "$1")
    source = F.when(source == "paid_social", "social").otherwise(source)
    revenue = F.coalesce("total_revenue", F.lit(0.0))
    return (
        src.model(fct_lead_scoring_features)
        .select(
            "customer_id",
            half_up(rule_score(segment, source, F.col("total_orders"), revenue), 6).alias("score"),
        )
        .withColumn("tier", rule_tier(F.col("score")))
    )


def run_log(spark: SparkSession, path: str, run_id: str, params: dict, metrics: DataFrame) -> DataFrame:
    """Appends one row per run (parameters and metrics as maps) and returns the log."""
    shown = F.create_map(*[F.lit(x) for k, v in sorted(params.items()) for x in (k, str(v))])
    row = metrics.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value")))).alias("metrics")).select(
        F.lit(run_id).alias("run_id"),
        F.lit(datetime.now(timezone.utc).replace(tzinfo=None)).alias("logged_at"),
        shown.alias("params"),
        "metrics",
    )
    return append(row, path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
