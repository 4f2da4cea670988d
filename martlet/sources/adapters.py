"""The logical sources as deterministic expressions over the star-schema test tables.

Every row of a test table is used: each order has a payment, a review score, a deal and an
opportunity, each part a category. Money is derived in whole cents, so sums are exact to the
cent in any order. Ad and web-traffic days are moved back 24 years so that they fall inside the
order history and the cross-domain joins have something to match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions.metrics import ad_ratios
from martlet.functions.numeric import count_if, money_mean, money_sum, pick
from martlet.operators.builders import (
    LEAD_SOURCES,
    LIFECYCLE_STAGES,
    accounts_from_sellers,
    assign_touch_credits,
    contacts_rollup,
    deals_from_orders,
    opportunities_from_orders,
    orders_with_revenue,
    spread,
)
from martlet.operators.ranking import number_rows

# Fixed values of the adapters.
TRAFFIC_DAYS_BACK = 8766
CHANNEL_GROUPS = [
    "organic_search", "paid_search", "paid_social", "direct", "email", "referral", "organic_social",
]
DEVICES = ["mobile", "desktop", "tablet"]
TOUCH_CHANNELS = [
    "brand_ads", "product_ads", "feed_ads", "story_ads", "natural_search", "newsletter", "partner_links", "typed_in",
]
TOUCH_PLATFORMS = ["google_ads", "google_ads", "meta_ads", "meta_ads", "ga4", "hubspot", "ga4", "ga4"]
GOOGLE_CAMPAIGNS = [
    ("G-AFR", "Africa Names", "SEARCH", 90.0),
    ("G-AME", "America Catalogue", "SHOPPING", 410.0),
    ("G-ASI", "Asia Terms", "SEARCH", 275.0),
    ("G-EUR", "Europe Banners", "DISPLAY", 135.0),
    ("G-MID", "Middle East Clips", "VIDEO", 60.0),
]
META_CAMPAIGNS = [
    ("M-BLD", "Building Leads", "CONVERSIONS", 180.0),
    ("M-CAR", "Automobile Reach", "AWARENESS", 45.0),
    ("M-FRN", "Furniture Range", "CATALOG_SALES", 220.0),
    ("M-MCH", "Machinery Returns", "CONVERSIONS", 130.0),
]
PAYMENT_TYPES = {
    "1-URGENT": "credit_card",
    "2-HIGH": "boleto",
    "3-MEDIUM": "debit_card",
    "4-NOT SPECIFIED": "voucher",
    "5-LOW": "not_defined",
}
SPLIT_PAYMENT_PRIORITIES = ["2-HIGH", "4-NOT SPECIFIED"]
TRANSLATIONS = [
    ("STANDARD", "standard_goods"),
    ("PROMO", "promotional_goods"),
    ("ECONOMY", "economy_goods"),
    ("LARGE", "large_goods"),
    ("MEDIUM", "medium_goods"),
]


# Columns of the test tables that the adapters read.
RAW_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": """p_partkey long, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "orders": """o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """event_id long, ts timestamp_ntz, user_id long, event_type string, value double,
        props string""",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
}


class RawTables:
    """The test tables, and the adapted tables built from them, each built once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._dir = sf_dir.rstrip("/")
        self._memo: dict[object, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._memo:
            reader = self.spark.read.schema(RAW_SCHEMAS[name])
            self._memo[name] = reader.parquet(f"{self._dir}/{name}.parquet")
        return self._memo[name]

    def adapted(self, fn: Callable[[RawTables], DataFrame]) -> DataFrame:
        if fn not in self._memo:
            self._memo[fn] = fn(self)
        return self._memo[fn]


def _cents(amount: str) -> Column:
    return F.round(F.col(amount) * 100).cast("long")


def _thousandth(amount: str) -> Column:
    """A thousandth of the amount, in whole cents."""
    return F.floor(_cents(amount) / 1000)


def _money(cents: Column) -> Column:
    return cents / F.lit(100.0)


def _later(ts: str, days: Column | int, hours: Column | int = 0) -> Column:
    as_int = [x.cast("int") if isinstance(x, Column) else F.lit(x) for x in (days, hours)]
    return F.col(ts) + F.make_dt_interval(*as_int)


def _lookup(mapping: dict[str, str], key: str) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), F.col(key))


def _fixed_rows(raw: RawTables, rows: list[tuple], columns: list[str]) -> DataFrame:
    """A small literal table whose size the optimizer knows (so it may be broadcast)."""
    structs = [F.struct(*[F.lit(v).alias(c) for v, c in zip(row, columns)]) for row in rows]
    return raw.spark.range(1).select(F.inline(F.array(*structs)))


def _orders(raw: RawTables) -> DataFrame:
    key, at = F.col("o_orderkey"), "o_orderdate"
    delivered = (F.col("o_orderstatus") == "F") & (key % 17 != 0)
    return raw("orders").select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        # nested, not a map: the optimizer turns a filter on it into one on the stored column
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .otherwise(F.when(F.col("o_orderstatus") == "O", "shipped").otherwise("processing"))
        .alias("order_status"),
        _later(at, 0, key % 24).alias("order_purchase_timestamp"),
        _later(at, 1).alias("order_approved_at"),
        _later(at, 2).alias("order_delivered_carrier_date"),
        F.when(delivered, _later(at, 1 + key % 30, key % 7)).alias("order_delivered_customer_date"),
        _later(at, 20).alias("order_estimated_delivery_date"),
        "o_orderpriority",
    )


def orders(raw: RawTables) -> DataFrame:
    return raw.adapted(_orders).drop("o_orderpriority")


LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_tax", "l_shipdate"]


def order_items(raw: RawTables) -> DataFrame:
    lines = raw("lineitem").select("l_orderkey", *LINE_ORDER)
    # a hundred line numbers to a slice: few slices for an order of few lines, many for a hot one
    sliced = F.floor(F.col("l_linenumber") / 100)
    return _as_items(number_rows(lines, "l_orderkey", LINE_ORDER, "order_item_id", slice_by=sliced), "order_item_id")


def order_lines(raw: RawTables) -> DataFrame:
    """``order_items`` without their number within the order, so without the work for it."""
    return _as_items(raw("lineitem"))


def _as_items(lines: DataFrame, *number: str) -> DataFrame:
    price = _thousandth("l_extendedprice")
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        *number,
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        _money(price).alias("price"),
        _money(F.floor(price * _cents("l_tax") / 100)).alias("freight_value"),
        F.col("l_shipdate").alias("shipping_limit_date"),
    )


def order_payments(raw: RawTables) -> DataFrame:
    """One payment per order, two for split priorities."""
    due = _thousandth("o_totalprice")
    split = F.col("o_orderpriority").isin(SPLIT_PAYMENT_PRIORITIES)
    first = F.when(split, F.floor(due * 3 / 4)).otherwise(due)

    def part(seq: int, kind: Column, cents: Column) -> Column:
        return F.struct(
            F.lit(seq).alias("payment_sequential"),
            kind.alias("payment_type"),
            (1 + F.col("o_orderkey") % 10).cast("int").alias("payment_installments"),
            _money(cents).alias("payment_value"),
        )

    one = part(1, _lookup(PAYMENT_TYPES, "o_orderpriority"), first)
    two = part(2, F.lit("voucher"), due - first)
    return (
        raw("orders")
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.inline(F.when(split, F.array(one, two)).otherwise(F.array(one))),
        )
    )


def order_reviews(raw: RawTables) -> DataFrame:
    key = F.col("o_orderkey")
    texts = raw("documents").select(F.col("doc_id").alias("o_orderkey"), "text")
    return (
        raw("orders")
        .select("o_orderkey", "o_orderdate")
        .join(texts, "o_orderkey", "left")
        .select(
            F.concat(F.lit("REV_"), key.cast("string")).alias("review_id"),
            key.alias("order_id"),
            (1 + key % 5).cast("int").alias("review_score"),
            F.lit(None).cast("string").alias("review_comment_title"),
            F.col("text").alias("review_comment_message"),
            _later("o_orderdate", 25).alias("review_creation_date"),
            _later("o_orderdate", 27).alias("review_answer_timestamp"),
        )
    )


def _places(raw: RawTables) -> DataFrame:
    return raw("nation").join(
        raw("region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", F.col("n_name").alias("_city"), F.col("r_name").alias("_state"))


def customers(raw: RawTables) -> DataFrame:
    return (
        raw("customer")
        .join(raw.adapted(_places), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("customer_unique_id"),
            F.col("c_nationkey").cast("string").alias("customer_zip_code_prefix"),
            F.col("_city").alias("customer_city"),
            F.col("_state").alias("customer_state"),
        )
    )


def _sellers(raw: RawTables) -> DataFrame:
    return (
        raw("supplier")
        .join(raw.adapted(_places), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("seller_id"),
            F.col("s_nationkey").cast("string").alias("seller_zip_code_prefix"),
            F.col("_city").alias("seller_city"),
            F.col("_state").alias("seller_state"),
            "s_acctbal",
        )
    )


def sellers(raw: RawTables) -> DataFrame:
    return raw.adapted(_sellers).drop("s_acctbal")


def products(raw: RawTables) -> DataFrame:
    size = F.col("p_size")
    return raw("part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_brand").alias("product_description_lenght"),
        (size % 4 + 1).alias("product_photos_qty"),
        F.col("p_retailprice").alias("product_weight_g"),
        size.cast("double").alias("product_length_cm"),
        (size % 7 + 1).cast("double").alias("product_height_cm"),
        (size % 5 + 1).cast("double").alias("product_width_cm"),
    )


def category_translation(raw: RawTables) -> DataFrame:
    return _fixed_rows(raw, TRANSLATIONS, ["product_category_name", "product_category_name_english"])


def _traffic(raw: RawTables) -> DataFrame:
    return raw("events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.date_sub(F.col("ts").cast("date"), TRAFFIC_DAYS_BACK).alias("date"),
    )


def _is(kind: str) -> Column:
    return F.col("event_type") == kind


def _value_of(kind: str) -> Column:
    return F.coalesce(money_sum(F.when(_is(kind), F.col("value"))), F.lit(0.0))


def ga4_daily_sessions(raw: RawTables) -> DataFrame:
    sessions, engaged = F.col("sessions"), F.col("engaged_sessions")
    return (
        raw.adapted(_traffic)
        .groupBy(
            "date",
            pick(CHANNEL_GROUPS, F.col("user_id") % 7).alias("channel_group"),
            pick(DEVICES, F.col("event_id") % 3).alias("device_category"),
        )
        .agg(
            F.count(F.lit(1)).alias("sessions"),
            count_if(F.col("event_type").isin("click", "purchase")).alias("engaged_sessions"),
            money_mean("value").alias("avg_session_duration_sec"),
            F.count_distinct("user_id").alias("_users"),
            count_if(_is("signup")).alias("new_users"),
            count_if(_is("purchase")).alias("conversions"),
            _value_of("purchase").alias("revenue"),
        )
        .select(
            "date", "channel_group", "device_category", "sessions", "engaged_sessions",
            (F.lit(100.0) * (sessions - engaged) / sessions).alias("bounce_rate"),
            "avg_session_duration_sec",
            (sessions / F.col("_users")).alias("pages_per_session"),
            "new_users", "conversions", "revenue",
            (F.lit(100.0) * F.col("conversions") / sessions).alias("conversion_rate"),
        )
    )


def google_ads_daily_performance(raw: RawTables) -> DataFrame:
    at = F.col("_at")
    daily = (
        raw.adapted(_traffic)
        .groupBy("date", (F.col("user_id") % len(GOOGLE_CAMPAIGNS)).alias("_at"))
        .agg(
            F.count(F.lit(1)).alias("impressions"),
            count_if(_is("click")).alias("clicks"),
            _value_of("view").alias("cost"),
            count_if(_is("purchase")).alias("conversions"),
            _value_of("purchase").alias("conversion_value"),
        )
    )
    derived = ad_ratios(*[F.col(c) for c in ("impressions", "clicks", "cost", "conversions", "conversion_value")])
    return daily.select(
        "date",
        pick([c[0] for c in GOOGLE_CAMPAIGNS], at).alias("campaign_id"),
        pick([c[1] for c in GOOGLE_CAMPAIGNS], at).alias("campaign_name"),
        pick([c[2] for c in GOOGLE_CAMPAIGNS], at).alias("campaign_type"),
        "impressions", "clicks", "cost", "conversions", "conversion_value",
        derived["ctr"].alias("ctr"),
        derived["cpc"].alias("avg_cpc"),
        derived["cost_per_conversion"].alias("cost_per_conversion"),
        derived["roas"].alias("roas"),
    )


def meta_ads_daily_performance(raw: RawTables) -> DataFrame:
    at = F.col("_at")
    daily = (
        raw.adapted(_traffic)
        .groupBy("date", (F.col("user_id") % len(META_CAMPAIGNS)).alias("_at"))
        .agg(
            F.count(F.lit(1)).alias("impressions"),
            F.count_distinct("user_id").alias("reach"),
            _value_of("click").alias("spend"),
            count_if(_is("click")).alias("link_clicks"),
            count_if(_is("purchase")).alias("purchases"),
            _value_of("purchase").alias("purchase_value"),
        )
    )
    derived = ad_ratios(*[F.col(c) for c in ("impressions", "link_clicks", "spend", "purchases", "purchase_value")])
    return daily.select(
        "date",
        pick([c[0] for c in META_CAMPAIGNS], at).alias("campaign_id"),
        pick([c[1] for c in META_CAMPAIGNS], at).alias("campaign_name"),
        pick([c[2] for c in META_CAMPAIGNS], at).alias("objective"),
        "impressions", "reach", "spend", "link_clicks",
        derived["ctr"].alias("ctr"),
        derived["cpc"].alias("cpc"),
        derived["cpm"].alias("cpm"),
        "purchases", "purchase_value",
        derived["cost_per_conversion"].alias("cost_per_purchase"),
        derived["roas"].alias("roas"),
    )


def google_ads_campaigns(raw: RawTables) -> DataFrame:
    columns = ["campaign_id", "campaign_name", "campaign_type", "daily_budget"]
    return _fixed_rows(raw, GOOGLE_CAMPAIGNS, columns)


def meta_ads_campaigns(raw: RawTables) -> DataFrame:
    columns = ["campaign_id", "campaign_name", "objective", "daily_budget"]
    return _fixed_rows(raw, META_CAMPAIGNS, columns)


def hubspot_contacts(raw: RawTables) -> DataFrame:
    """Customers with delivered orders, keyed by the person's id."""
    history = contacts_rollup(raw.adapted(customers), orders_with_revenue(raw.adapted(orders), raw.adapted(order_payments)))
    names = raw("customer").select(
        F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("customer_unique_id"),
        "c_custkey", "c_name", "c_mktsegment",
    )
    key = F.col("c_custkey")
    return history.join(names, "customer_unique_id").select(
        F.concat(F.lit("HS_"), key.cast("string")).alias("contact_id"),
        F.col("customer_unique_id").alias("customer_id"),
        F.concat(F.lower(F.translate("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
        F.initcap("c_mktsegment").alias("first_name"),
        F.col("city").alias("last_name"),
        "city",
        "state",
        F.date_sub("first_order_date", (key % 31).cast("int")).alias("create_date"),
        spread(key, LIFECYCLE_STAGES).alias("lifecycle_stage"),
        spread(key, LEAD_SOURCES).alias("lead_source"),
        "num_orders", "total_revenue", "first_order_date", "last_activity_date",
    )


def _all_orders_with_revenue(raw: RawTables) -> DataFrame:
    return orders_with_revenue(raw.adapted(_orders), raw.adapted(order_payments), delivered_only=False)


def hubspot_deals(raw: RawTables) -> DataFrame:
    lost = (F.col("order_status") == "processing") & (F.col("o_orderpriority") == "5-LOW")
    return deals_from_orders(raw.adapted(_all_orders_with_revenue), lost, F.col("order_id"))


def salesforce_opportunities(raw: RawTables) -> DataFrame:
    lost = (F.col("order_status") == "processing") & (F.col("o_orderpriority") == "3-MEDIUM")
    return opportunities_from_orders(raw.adapted(_all_orders_with_revenue), lost, F.col("order_id"))


def salesforce_accounts(raw: RawTables) -> DataFrame:
    return accounts_from_sellers(raw.adapted(_sellers), _money(_cents("s_acctbal")), F.col("seller_id"))


def marketing_attribution(raw: RawTables) -> DataFrame:
    """Order lines as touches, in date order; the supplier stands for the channel."""
    order_by = ["_days_before", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    touches = raw("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        (-(F.col("l_partkey") % 14)).cast("int").alias("_days_before"),
    )
    credited = assign_touch_credits(touches, order_by, key="l_orderkey")
    placed = raw("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        _money(_thousandth("o_totalprice")).alias("order_revenue"),
    )
    at = F.col("l_suppkey") % len(TOUCH_CHANNELS)
    return credited.withColumnRenamed("l_orderkey", "order_id").join(placed, "order_id").select(
        "order_id",
        "touchpoint_position",
        "total_touchpoints",
        pick(TOUCH_CHANNELS, at).alias("channel"),
        pick(TOUCH_PLATFORMS, at).alias("platform"),
        F.date_add("order_date", F.col("_days_before")).alias("touchpoint_date"),
        "order_date",
        "order_revenue",
        "first_touch_credit",
        "last_touch_credit",
        "linear_credit",
    )


def web_hits(raw: RawTables) -> DataFrame:
    """Single web events with their time and attributes, for windows, sessions and as-of joins."""
    return raw("events").select(
        "event_id",
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("customer_id"),
        "event_type",
        pick(CHANNEL_GROUPS, F.col("event_id") % 7).alias("channel"),
        (F.col("ts").cast("timestamp") - F.expr(f"INTERVAL {TRAFFIC_DAYS_BACK} DAYS")).alias("ts"),
        "value",
        "props",
    )


def web_events(raw: RawTables) -> DataFrame:
    """Single web events of known people (for lead features and touchpoints)."""
    return raw.adapted(_traffic).select(
        "event_id",
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("customer_id"),
        "event_type",
        pick(CHANNEL_GROUPS, F.col("event_id") % 7).alias("channel"),
        F.col("date").alias("event_date"),
        "value",
    )


ADAPTERS: dict[str, Callable[[RawTables], DataFrame]] = {
    fn.__name__: fn
    for fn in (
        orders, order_items, order_payments, order_reviews, customers, sellers, products,
        category_translation, google_ads_daily_performance, google_ads_campaigns,
        meta_ads_daily_performance, meta_ads_campaigns, ga4_daily_sessions, hubspot_contacts,
        hubspot_deals, salesforce_opportunities, salesforce_accounts, marketing_attribution,
        web_events, web_hits,
    )
}
