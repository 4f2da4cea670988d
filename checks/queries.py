"""The SQL of every query that SQL can state, by the query's name."""

from __future__ import annotations

from checks.tables import (
    GA4_CHANNELS,
    T,
    div,
    isum,
    money,
    money_avg,
    r,
    week,
    with_tables,
)

Q: dict[str, str] = {}


def avg6(x: str) -> str:
    return r(f"AVG({x})", 6)


def n_if(cond: str) -> str:
    return f"COUNT(*) FILTER (WHERE {cond})"


def pct2(top: str, base: str) -> str:
    """100 * top / base to two decimals, 0 on a zero base."""
    return f"COALESCE({r(f'1e2 * {top} / NULLIF({base}, 0)', 2)}, 0::DOUBLE)"


# Models: the table expression itself
for _name in T:
    if _name.startswith(("stg_", "int_", "fct_", "dim_")):
        Q[_name] = f"SELECT * FROM {_name}"
for _name in ("time_spine", "time_decay_normalised", "channel_performance_by_platform"):
    Q[_name] = f"SELECT * FROM {_name}"

Q["time_decay_credit"] = f"""
SELECT order_id, touchpoint_position,
  {r("POW(2::DOUBLE, -(order_date - touchpoint_date) / 7::DOUBLE)", 8)} AS credit
FROM stg_marketing_attribution"""

# Sources and sinks
Q["read_csv_table"] = "SELECT * FROM src_order_payments"
Q["read_source"] = "SELECT * FROM src_customers"
Q["write_table"] = "SELECT * FROM fct_marketing_daily"
Q["marketing_daily_increments"] = "SELECT * FROM fct_marketing_daily"
Q["append"] = "SELECT * FROM int_campaign_unified"
Q["upsert"] = """
SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
  CASE customer_state WHEN 'ASIA' THEN customer_city || '_2' ELSE customer_city END AS customer_city, customer_state
FROM stg_customers
UNION ALL
SELECT -1 - seller_id, 'S' || seller_id, seller_zip_code_prefix, seller_city, seller_state FROM stg_sellers"""
Q["null_clean"] = "SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM src_web_events"
_SOURCES = [n.removeprefix("src_") for n in T if n.startswith("src_") and n != "src_web_events"]
Q["load_report"] = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM src_{n}" for n in _SOURCES
)
_COLUMNS = {
    "orders": "order_id bigint, customer_id bigint, order_status string, order_purchase_timestamp timestamp_ntz, "
    "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
    "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
    "customers": "customer_id bigint, customer_unique_id string, customer_zip_code_prefix string, "
    "customer_city string, customer_state string",
    "order_payments": "order_id bigint, payment_sequential int, payment_type string, payment_installments int, "
    "payment_value double",
    "ga4_daily_sessions": "date date, channel_group string, device_category string, sessions bigint, "
    "engaged_sessions bigint, bounce_rate double, avg_session_duration_sec double, pages_per_session double, "
    "new_users bigint, conversions bigint, revenue double, conversion_rate double",
}


def _described(table: str, columns: str) -> str:
    pairs = [c.split() for c in columns.split(", ")]
    rows = ", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(pairs, 1))
    return f"""
SELECT '{table}' AS table_name, (SELECT COUNT(*) FROM src_{table}) AS row_count, CAST({len(pairs)} AS INTEGER) AS column_count,
  CAST(p AS INTEGER) AS column_position, c AS column_name, t AS column_type FROM (VALUES {rows}) AS v(p, c, t)"""


Q["describe_tables"] = "\nUNION ALL\n".join(_described(t, c) for t, c in _COLUMNS.items())
Q["limit_rows"] = "SELECT * FROM src_orders ORDER BY order_purchase_timestamp, order_id LIMIT 1000"
Q["preview"] = "SELECT * FROM fct_daily_revenue ORDER BY order_date LIMIT 25"
Q["run_sql"] = """
SELECT customer_state, COUNT(*) AS customers, COUNT(DISTINCT customer_city) AS cities FROM stg_customers GROUP BY ALL"""

# Metrics


def grained(grain: str, day: str) -> str:
    return f"CAST(DATE_TRUNC('{grain}', {day}) AS DATE)"


REVENUE = money("revenue")
Q["metric_total_revenue"] = f"""
SELECT {grained('month', 'order_date')} AS metric_time, {REVENUE} AS total_revenue FROM fct_orders GROUP BY 1"""
Q["metric_total_spend"] = f"""
SELECT {week('date')} AS metric_time, {money('total_spend')} AS total_spend FROM fct_marketing_daily GROUP BY 1"""
Q["metric_total_sessions"] = f"""
SELECT channel_group, {isum('sessions')} AS total_sessions FROM stg_ga4_sessions GROUP BY 1"""
Q["metric_total_clicks"] = f"""
SELECT date AS metric_time, platform, {isum('clicks')} AS total_clicks FROM int_campaign_unified GROUP BY 1, 2"""
Q["metric_total_new_users"] = f"""
SELECT {week('date')} AS metric_time, {isum('new_users')} AS total_new_users FROM stg_ga4_sessions GROUP BY 1"""
Q["metric_total_engaged_sessions"] = f"""
SELECT device_category, {isum('engaged_sessions')} AS total_engaged_sessions FROM stg_ga4_sessions GROUP BY 1"""
Q["metric_total_orders"] = f"""
SELECT {grained('month', 'order_date')} AS metric_time, primary_payment_type, COUNT(DISTINCT order_id) AS total_orders
FROM fct_orders GROUP BY 1, 2"""
Q["metric_average_order_value"] = f"""
SELECT last_touch_channel, {money_avg('revenue')} AS average_order_value FROM fct_orders GROUP BY 1"""
Q["metric_pipeline_value"] = f"""
SELECT source, stage, {money('amount')} AS total_pipeline_value FROM crm_pipeline GROUP BY 1, 2"""
Q["metric_total_deals"] = f"""
SELECT {grained('year', 'close_date')} AS metric_time, source, COUNT(DISTINCT deal_id) AS total_deals
FROM crm_pipeline GROUP BY 1, 2"""
Q["metric_channel_spend"] = "SELECT channel, total_spend AS channel_spend FROM fct_channel_performance"
Q["metric_channel_revenue"] = "SELECT channel, attributed_revenue AS channel_revenue FROM fct_channel_performance"
Q["metric_channel_orders"] = "SELECT channel, total_orders AS channel_orders FROM fct_channel_performance"
Q["metric_blended_roas"] = f"""
SELECT metric_time, total_revenue, total_spend, {div('total_revenue', 'total_spend')} AS blended_roas
FROM (SELECT {week('order_date')} AS metric_time, {REVENUE} AS total_revenue FROM fct_orders GROUP BY 1) a
FULL JOIN (SELECT {week('date')} AS metric_time, {money('total_spend')} AS total_spend FROM fct_marketing_daily GROUP BY 1) b
  USING (metric_time)"""
Q["metric_channel_roas"] = f"""
SELECT channel, {div('attributed_revenue', 'total_spend')} AS channel_roas FROM fct_channel_performance"""
Q["metric_customer_acquisition_cost"] = f"""
SELECT channel, {div('total_spend', 'total_orders')} AS customer_acquisition_cost FROM fct_channel_performance"""
Q["metric_cost_per_session"] = f"""
SELECT metric_time, {div('a', 'b')} AS cost_per_session
FROM (SELECT date AS metric_time, {money('total_spend')} AS a FROM fct_marketing_daily GROUP BY 1) x
FULL JOIN (SELECT date AS metric_time, {isum('sessions')} AS b FROM stg_ga4_sessions GROUP BY 1) y USING (metric_time)"""
Q["metric_engagement_rate"] = f"""
SELECT {week('date')} AS metric_time, channel_group, {div(isum('engaged_sessions'), isum('sessions'))} AS engagement_rate
FROM stg_ga4_sessions GROUP BY 1, 2"""
Q["metric_session_conversion_rate"] = f"""
SELECT metric_time, {div('a', 'b')} AS session_conversion_rate
FROM (SELECT {week('order_date')} AS metric_time, COUNT(DISTINCT order_id) AS a FROM fct_orders GROUP BY 1) x
FULL JOIN (SELECT {week('date')} AS metric_time, {isum('sessions')} AS b FROM stg_ga4_sessions GROUP BY 1) y
  USING (metric_time)"""
Q["metric_conversions"] = f"""
SELECT metric_time, ga4_conversions, ad_conversions
FROM (SELECT date AS metric_time, {isum('conversions')} AS ga4_conversions FROM stg_ga4_sessions GROUP BY 1) x
FULL JOIN (SELECT date AS metric_time, {isum('total_conversions')} AS ad_conversions FROM fct_marketing_daily GROUP BY 1) y
  USING (metric_time)"""
Q["metric_win_rate"] = f"""
SELECT source, {div(n_if("LOWER(REPLACE(stage, ' ', '_')) = 'closed_won'"), n_if("LOWER(stage) LIKE 'closed%'"))} AS win_rate
FROM crm_pipeline GROUP BY 1"""
Q["metric_velocity"] = f"""
SELECT weighted_value, days, {div('weighted_value', 'days')} AS pipeline_velocity
FROM (SELECT {r('SUM(weighted_amount)', 4)} AS weighted_value,
  CAST(MAX(created_date) - MIN(created_date) + 1 AS INTEGER) AS days FROM stg_salesforce_opportunities)"""
Q["metric_blended_cac"] = f"""
SELECT total_spend, new_customers, {div('total_spend', 'new_customers')} AS blended_cac
FROM (SELECT {money('total_spend')} AS total_spend FROM fct_marketing_daily),
  (SELECT COUNT(DISTINCT customer_id) AS new_customers FROM fct_orders)"""
Q["query_metric_overall"] = f"""
SELECT total_revenue, total_orders, average_order_value, total_sessions, {div('total_revenue', 'spend')} AS blended_roas
FROM (SELECT {REVENUE} AS total_revenue, COUNT(DISTINCT order_id) AS total_orders,
    {money_avg('revenue')} AS average_order_value FROM fct_orders),
  (SELECT {isum('sessions')} AS total_sessions FROM stg_ga4_sessions),
  (SELECT {money('total_spend')} AS spend FROM fct_marketing_daily)"""
Q["query_metric_where"] = f"""
SELECT {grained('month', 'date')} AS metric_time, channel_group, {isum('sessions')} AS total_sessions,
  {div(isum('engaged_sessions'), isum('sessions'))} AS engagement_rate
FROM stg_ga4_sessions WHERE device_category <> 'tablet' GROUP BY 1, 2"""

_M = grained("month", "date")
Q["metric_subtotals"] = f"""
SELECT metric_time, channel_group, device_category, level, total_sessions, {div('engaged', 'total_sessions')} AS engagement_rate
FROM (SELECT {_M} AS metric_time, channel_group, device_category, GROUPING({_M}, channel_group, device_category) AS level,
    {isum('sessions')} AS total_sessions, {isum('engaged_sessions')} AS engaged
  FROM stg_ga4_sessions
  GROUP BY GROUPING SETS (({_M}, channel_group, device_category), ({_M}, channel_group), ({_M}), ()))"""
Q["metric_cube"] = f"""
SELECT source, stage, lead_source, GROUPING(source, stage, lead_source) AS level, COUNT(DISTINCT deal_id) AS total_deals,
  {money('amount')} AS total_pipeline_value,
  {div(n_if("LOWER(REPLACE(stage, ' ', '_')) = 'closed_won'"), n_if("LOWER(stage) LIKE 'closed%'"))} AS win_rate
FROM crm_pipeline
GROUP BY GROUPING SETS ((source, stage, lead_source), (source, stage), (source, lead_source), (stage, lead_source), (source), (stage), (lead_source), ())"""

# Time
Q["deal_stage_at_touch"] = """
SELECT h.event_id, h.customer_id, h.ts, d.deal_id, d.deal_stage
FROM hits h ASOF LEFT JOIN (
  SELECT c.customer_unique_id AS customer_id, o.order_purchase_timestamp AS at, MAX(d.deal_id) AS deal_id, ARG_MAX(d.deal_stage, d.deal_id) AS deal_stage
  FROM stg_hubspot_deals d JOIN stg_orders o USING (order_id) JOIN stg_customers c ON c.customer_id = o.customer_id
  WHERE o.order_purchase_timestamp IS NOT NULL GROUP BY 1, 2
) d ON h.customer_id = d.customer_id AND h.ts >= d.at"""
Q["touch_sessions"] = """
SELECT customer_id, MIN(ts) AS session_start, MAX(ts) AS session_end, COUNT(*) AS events, COUNT(*) FILTER (WHERE event_type = 'click') AS clicks
FROM (
  SELECT *, SUM(opens) OVER (PARTITION BY customer_id ORDER BY ts, event_id) AS session FROM (
    SELECT *, CASE WHEN ts <= LAG(ts) OVER (PARTITION BY customer_id ORDER BY ts, event_id) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM hits))
GROUP BY customer_id, session"""
Q["touch_sessions_stream"] = Q["touch_sessions"]
Q["traffic_windows_stream"] = f"""
SELECT CAST(window_start AS DATE) AS window_day, window_start, channel, COUNT(*) AS events, COUNT(*) FILTER (WHERE event_type = 'click') AS clicks,
  COALESCE(CAST(SUM(CASE WHEN event_type = 'purchase' THEN ROUND(value * 100) END) AS BIGINT), 0) / 1e2 AS purchase_value
FROM (
  SELECT *, DATE_TRUNC('hour', ts) AS window_start FROM hits WHERE event_id % 50 <> 0
  UNION ALL SELECT *, DATE_TRUNC('hour', ts) - INTERVAL 1 HOUR FROM hits WHERE event_id % 50 <> 0)
GROUP BY 1, 2, 3"""
Q["late_events_stream"] = "SELECT channel, COUNT(*) AS late_events FROM hits WHERE event_id % 50 = 0 GROUP BY 1"

# References, differences and attributes
_EDGES = (
    ("stg_order_items", "order_id", "stg_orders", "order_id"),
    ("stg_order_payments", "order_id", "stg_orders", "order_id"),
    ("stg_orders", "customer_id", "stg_customers", "customer_id"),
    ("stg_customers", "customer_id", "stg_orders", "customer_id"),
    ("stg_order_items", "seller_id", "stg_sellers", "seller_id"),
    ("stg_sellers", "seller_id", "stg_order_items", "seller_id"),
    ("hits", "customer_id", "stg_customers", "customer_unique_id"),
)
Q["reference_report"] = " UNION ALL ".join(
    f"SELECT '{'web_hits' if a == 'hits' else a}' AS child, '{c}' AS \"column\", '{b}' AS parent, "
    f"COUNT(DISTINCT {c}) AS missing_values, COUNT(*) AS missing_rows "
    f"FROM {a} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {k} FROM {b} WHERE {k} IS NOT NULL)"
    for a, c, b, k in _EDGES
)
Q["places_changed"] = """
SELECT city, state, CAST(SUM(o) AS BIGINT) AS old_copies, CAST(SUM(n) AS BIGINT) AS new_copies FROM (
  SELECT customer_city AS city, customer_state AS state, 1 AS o, 0 AS n FROM stg_customers
  UNION ALL SELECT seller_city, seller_state, 0, 1 FROM stg_sellers)
GROUP BY city, state HAVING SUM(o) <> SUM(n)"""
Q["event_attributes"] = """
SELECT event_id, name, json_extract_string(props, '$."' || name || '"') AS value
FROM (SELECT event_id, props, UNNEST(json_keys(props)) AS name FROM events)"""
Q["attribute_by_channel"] = """
SELECT channel, COUNT(k) AS events, MIN(k) AS least, MAX(k) AS most, CAST(SUM(k) AS BIGINT) AS total
FROM (SELECT h.channel, CAST(json_extract(e.props, '$.k') AS BIGINT) AS k FROM hits h JOIN events e USING (event_id))
GROUP BY channel"""

# Platform tools
Q["google_campaign_performance"] = f"""
SELECT *, {div('clicks', 'impressions')} AS ctr, {div('cost', 'clicks')} AS cpc, {div('conversions', 'clicks')} AS cvr
FROM (SELECT campaign_id, campaign_name, campaign_type, {isum('impressions')} AS impressions, {isum('clicks')} AS clicks,
  {money('cost')} AS cost, {isum('conversions')} AS conversions FROM stg_google_ads_performance GROUP BY ALL)"""
Q["google_list_campaigns"] = """
SELECT DISTINCT campaign_id, campaign_name, campaign_type FROM stg_google_ads_performance"""
Q["meta_campaign_insights"] = f"""
SELECT *, {div('spend', 'impressions')} * 1000 AS cpm, {div('spend', 'link_clicks')} AS cpc,
  {div('purchases * 100', 'spend')} AS roas
FROM (SELECT campaign_id, campaign_name, objective, {isum('impressions')} AS impressions, {isum('reach')} AS reach,
  {money('spend')} AS spend, {isum('link_clicks')} AS link_clicks, {isum('purchases')} AS purchases
  FROM stg_meta_ads_performance GROUP BY ALL)"""
Q["meta_list_campaigns"] = "SELECT DISTINCT campaign_id, campaign_name, objective FROM stg_meta_ads_performance"
Q["ga4_traffic_by_channel"] = f"""
SELECT *, {div('engaged_sessions', 'sessions')} AS engagement_rate, {div('conversions', 'sessions')} AS conversion_rate
FROM (SELECT channel_group, {isum('sessions')} AS sessions, {isum('engaged_sessions')} AS engaged_sessions,
  {isum('conversions')} AS conversions FROM stg_ga4_sessions GROUP BY ALL)"""
Q["ga4_daily_trends"] = f"""
SELECT date, {isum('sessions')} AS sessions, {isum('conversions')} AS conversions
FROM stg_ga4_sessions WHERE channel_group = 'organic_search' GROUP BY date"""
Q["contacts_summary"] = """
SELECT 'lifecycle_stage' AS kind, lifecycle_stage AS key, COUNT(*) AS contacts FROM stg_hubspot_contacts GROUP BY ALL
UNION ALL
(SELECT 'city', city, COUNT(*) AS n FROM stg_hubspot_contacts GROUP BY ALL ORDER BY n DESC, city LIMIT 10)
UNION ALL
SELECT 'total', 'all', COUNT(*) FROM stg_hubspot_contacts"""
Q["deal_stage_summary"] = f"""
SELECT deal_stage, COUNT(deal_id) AS deal_count, {money('amount')} AS total_value FROM stg_hubspot_deals GROUP BY 1"""
Q["search_contacts"] = """
SELECT * FROM stg_hubspot_contacts
WHERE LOWER(email) LIKE '%nation\\_1%' ESCAPE '\\' OR LOWER(first_name) LIKE '%nation\\_1%' ESCAPE '\\'
  OR LOWER(last_name) LIKE '%nation\\_1%' ESCAPE '\\'
ORDER BY contact_id LIMIT 10"""
Q["opportunity_stages"] = f"""
SELECT stage, COUNT(opportunity_id) AS opp_count, {money('amount')} AS amount FROM stg_salesforce_opportunities GROUP BY 1"""
Q["revenue_by_source"] = f"""
SELECT lead_source, {money('amount')} AS total_revenue, COUNT(opportunity_id) AS won_count
FROM stg_salesforce_opportunities WHERE is_won GROUP BY 1"""

# Panels
Q["daily_revenue_range"] = "SELECT * EXCLUDE (new_customers) FROM fct_daily_revenue"
Q["weekly_revenue"] = f"""
SELECT {week('order_date')} AS week, {money('total_revenue')} AS total_revenue, {isum('order_count')} AS order_count,
  {avg6('avg_order_value')} AS avg_aov FROM fct_daily_revenue GROUP BY 1"""
Q["weekly_aov"] = f"""
SELECT {week('order_date')} AS week, {avg6('avg_order_value')} AS aov FROM fct_daily_revenue GROUP BY 1"""
Q["weekly_spend"] = f"""
SELECT {week('date')} AS week, {money('total_google_spend')} AS google_spend, {money('total_meta_spend')} AS meta_spend,
  {money('total_spend')} AS total_spend FROM fct_marketing_daily GROUP BY 1"""
Q["ga4_channel_summary"] = f"""
SELECT channel_group, {isum('sessions')} AS sessions, {isum('new_users')} AS new_users,
  {isum('engaged_sessions')} AS engaged_sessions, {avg6('bounce_rate')} AS avg_bounce_rate,
  {avg6('avg_session_duration_sec')} AS avg_duration, {avg6('pages_per_session')} AS avg_pages,
  {avg6('engagement_rate')} AS engagement_rate FROM stg_ga4_sessions GROUP BY 1"""
Q["ga4_weekly_by_channel"] = f"""
SELECT {week('date')} AS week, channel_group, {isum('sessions')} AS sessions FROM stg_ga4_sessions GROUP BY 1, 2"""
Q["ga4_weekly_totals"] = f"""
SELECT {week('date')} AS week, {isum('sessions')} AS sessions, {isum('new_users')} AS new_users,
  {isum('engaged_sessions')} AS engaged_sessions, {avg6('engagement_rate')} AS engagement_rate
FROM stg_ga4_sessions GROUP BY 1"""
Q["ga4_by_device"] = f"""
SELECT device_category, {isum('sessions')} AS sessions, {isum('engaged_sessions')} AS engaged_sessions
FROM stg_ga4_sessions GROUP BY 1"""


def _guarded(value: str, cost: str) -> str:
    return f"CASE WHEN {money(cost)} > 0 THEN {div(money(value), money(cost))} ELSE 0 END::DOUBLE"


Q["google_perf"] = f"""
SELECT campaign_name, campaign_type, {isum('impressions')} AS impressions, {isum('clicks')} AS clicks,
  {money('cost')} AS cost, {isum('conversions')} AS conversions, {money('conversion_value')} AS conversion_value,
  {avg6('ctr')} * 100 AS avg_ctr, {avg6('ctr')} AS avg_ctr_pct, {avg6('avg_cpc')} AS avg_cpc,
  {_guarded('conversion_value', 'cost')} AS roas FROM stg_google_ads_performance GROUP BY 1, 2"""
Q["meta_perf"] = f"""
SELECT campaign_name, objective, {isum('impressions')} AS impressions, {isum('reach')} AS reach,
  {money('spend')} AS spend, {isum('link_clicks')} AS link_clicks, {isum('purchases')} AS purchases,
  {money('purchase_value')} AS purchase_value, {avg6('ctr')} * 100 AS avg_ctr, {avg6('ctr')} AS avg_ctr_pct,
  {avg6('cpm')} AS avg_cpm, {_guarded('purchase_value', 'spend')} AS roas FROM stg_meta_ads_performance GROUP BY 1, 2"""
Q["google_weekly"] = f"""
SELECT {week('date')} AS week, {money('cost')} AS google_spend, {isum('conversions')} AS google_conv,
  {_guarded('conversion_value', 'cost')} AS google_roas FROM stg_google_ads_performance GROUP BY 1"""
Q["meta_weekly"] = f"""
SELECT {week('date')} AS week, {money('spend')} AS meta_spend, {isum('purchases')} AS meta_purch,
  {_guarded('purchase_value', 'spend')} AS meta_roas FROM stg_meta_ads_performance GROUP BY 1"""
Q["spend_by_type"] = f"""
SELECT platform, campaign_category AS category, {money('spend')} AS spend FROM int_campaign_unified GROUP BY 1, 2"""
Q["platform_roas"] = f"""
SELECT platform, {_guarded('revenue', 'spend')} AS roas FROM int_campaign_unified GROUP BY 1"""
Q["attribution_ranked"] = "SELECT * FROM fct_marketing_attribution"
Q["top_channel"] = f"""
SELECT (SELECT channel FROM fct_marketing_attribution ORDER BY linear_revenue DESC, channel DESC LIMIT 1) AS top_channel,
  {money('linear_revenue')} AS attributed_revenue, COUNT(*) AS channels FROM fct_marketing_attribution"""
Q["ranked_channel_funnel"] = "SELECT * FROM fct_pipeline"
Q["top_categories"] = f"""
SELECT p.product_category_name AS category, {money('i.price')} AS revenue, COUNT(DISTINCT i.order_id) AS orders
FROM stg_order_items i JOIN stg_products p USING (product_id) JOIN stg_orders o USING (order_id)
WHERE o.order_status = 'delivered' GROUP BY 1 ORDER BY revenue DESC, category LIMIT 15"""
Q["revenue_by_state"] = f"""
SELECT customer_state AS state, {REVENUE} AS revenue, COUNT(DISTINCT order_id) AS orders FROM fct_orders GROUP BY 1"""
Q["payment_distribution"] = f"""
SELECT payment_type, COUNT(*) AS cnt, {money('payment_value')} AS total
FROM stg_order_payments JOIN stg_orders USING (order_id) GROUP BY 1"""
Q["payment_share"] = f"""
SELECT *, {r('total * 1e2 / SUM(total) OVER ()', 6)} AS share_pct
FROM (SELECT payment_type, total FROM ({Q['payment_distribution']}))"""
Q["review_distribution"] = """
SELECT review_score, COUNT(*) AS cnt FROM stg_order_reviews JOIN stg_orders USING (order_id) GROUP BY 1"""
Q["delivery_stats"] = f"""
SELECT AVG(delivery_days) AS avg_days, {div(n_if('is_late_delivery') + ' * 1e2', 'COUNT(*)')} AS late_pct FROM fct_orders"""
Q["hubspot_stages"] = f"""
SELECT deal_stage, COUNT(*) AS deals, {money('amount')} AS pipeline_value FROM stg_hubspot_deals GROUP BY 1"""
Q["sf_stages"] = f"""
SELECT stage, COUNT(*) AS opportunities, {money('amount')} AS pipeline_value, AVG(probability) * 100 AS avg_probability_pct,
  AVG(probability) AS avg_probability FROM stg_salesforce_opportunities GROUP BY 1"""
Q["hubspot_by_source"] = f"""
SELECT lead_source, COUNT(*) AS deals, {money('amount')} AS value FROM stg_hubspot_deals GROUP BY 1"""
Q["sf_by_source"] = f"""
SELECT lead_source, COUNT(*) AS opps, {money('amount')} AS value FROM stg_salesforce_opportunities GROUP BY 1"""
Q["hubspot_weekly"] = f"""
SELECT {week('create_date')} AS week, {money('amount')} AS value FROM stg_hubspot_deals GROUP BY 1"""
Q["customer_segments"] = f"""
SELECT customer_segment, COUNT(*) AS customers, {money('total_revenue')} AS revenue, {avg6('avg_order_value')} AS avg_aov,
  AVG(total_orders) AS avg_orders, {isum('is_high_value')} AS high_value_count
FROM fct_lead_scoring_features GROUP BY 1"""
Q["segment_share"] = f"""
SELECT customer_segment, COUNT(*) AS customers, {r('COUNT(*) * 1e2 / SUM(COUNT(*)) OVER ()', 6)} AS share_pct
FROM fct_lead_scoring_features GROUP BY 1"""
Q["lead_source_perf"] = f"""
SELECT lead_source, COUNT(*) AS customers, {money('total_revenue')} AS revenue, {money_avg('total_revenue')} AS avg_revenue,
  {div(n_if('is_high_value = 1') + ' * 1e2', 'COUNT(*)')} AS high_value_pct
FROM fct_lead_scoring_features WHERE lead_source IS NOT NULL GROUP BY 1"""
Q["revenue_histogram"] = """
SELECT b AS bucket, COUNT(*) AS customers FROM fct_lead_scoring_features
JOIN (VALUES (-1e18, 100, '$0–100'), (100, 250, '$100–250'), (250, 500, '$250–500'), (500, 1000, '$500–1K'),
  (1000, 2500, '$1K–2.5K'), (2500, 1e19, '$2.5K+')) AS v(lo, hi, b)
  ON COALESCE(total_revenue, 1e18) >= lo AND COALESCE(total_revenue, 1e18) < hi GROUP BY 1"""
_AMOUNT = "CASE WHEN {} THEN amount END"
Q["kpi_summary"] = f"""
SELECT rev AS total_revenue, n AS total_orders, s AS total_sessions, nu AS new_users, e AS engaged_sessions,
  {r('g + m', 2)} AS total_spend, {div('rev', r('g + m', 2))} AS blended_roas,
  {r('ho + so', 2)} AS open_pipeline, {r('hw + sw', 2)} AS won_pipeline, avg_aov, avg_delivery_days, late_pct,
  total_customers, high_value_customers, {div('high_value_customers * 1e2', 'total_customers')} AS high_value_pct,
  {div('cr', 'total_customers')} AS avg_ltv
FROM (SELECT {money('total_revenue')} AS rev, {isum('order_count')} AS n, {avg6('avg_order_value')} AS avg_aov
      FROM fct_daily_revenue),
  (SELECT {isum('sessions')} AS s, {isum('new_users')} AS nu, {isum('engaged_sessions')} AS e FROM stg_ga4_sessions),
  (SELECT {money('cost')} AS g FROM stg_google_ads_performance), (SELECT {money('spend')} AS m FROM stg_meta_ads_performance),
  (SELECT {money(_AMOUNT.format('NOT is_closed_won'))} AS ho, {money(_AMOUNT.format('is_closed_won'))} AS hw
   FROM stg_hubspot_deals),
  (SELECT {money(_AMOUNT.format('NOT is_won'))} AS so, {money(_AMOUNT.format('is_won'))} AS sw
   FROM stg_salesforce_opportunities),
  (SELECT COUNT(*) AS total_customers, {isum('is_high_value')} AS high_value_customers, {money('total_revenue')} AS cr
   FROM fct_lead_scoring_features),
  (SELECT AVG(delivery_days) AS avg_delivery_days, {div(n_if('is_late_delivery') + ' * 1e2', 'COUNT(*)')} AS late_pct
   FROM fct_orders)"""
Q["sparkline"] = f"""
SELECT {week('order_date')} AS week, {money('total_revenue')} AS total_revenue
FROM fct_daily_revenue GROUP BY 1 ORDER BY 1 DESC LIMIT 14"""
Q["weekly_roas"] = f"""
SELECT a.week, a.total_revenue, b.total_spend, {div('a.total_revenue', 'b.total_spend')} AS roas
FROM ({Q['weekly_revenue']}) a JOIN ({Q['weekly_spend']}) b ON a.week = b.week"""
Q["funnel_overview"] = f"""
SELECT 1 AS step, 'sessions' AS stage, {isum('sessions')} AS value FROM stg_ga4_sessions
UNION ALL SELECT 2, 'new_users', {isum('new_users')} FROM stg_ga4_sessions
UNION ALL SELECT 3, 'engaged_sessions', {isum('engaged_sessions')} FROM stg_ga4_sessions
UNION ALL SELECT 4, 'orders', COUNT(DISTINCT order_id) FROM fct_orders"""
_PIVOT = ", ".join(
    f"CAST(COALESCE(SUM(sessions) FILTER (WHERE channel_group = '{c}'), 0) AS BIGINT) AS {c}" for c in GA4_CHANNELS
)
Q["sessions_pivot"] = f"SELECT {week('date')} AS week, {_PIVOT} FROM stg_ga4_sessions GROUP BY 1"
Q["engagement_by_channel"] = f"""
SELECT channel_group, sessions, new_users, engaged_sessions, {div('engaged_sessions * 1e2', 'sessions')} AS engagement_rate,
  {r('avg_duration / 60', 6)} AS avg_duration_min, avg_pages FROM ({Q['ga4_channel_summary']})"""
Q["attribution_long"] = """
SELECT channel, 'First touch' AS model, first_touch_revenue AS revenue FROM fct_marketing_attribution
UNION ALL SELECT channel, 'Last touch', last_touch_revenue FROM fct_marketing_attribution
UNION ALL SELECT channel, 'Linear', linear_revenue FROM fct_marketing_attribution
UNION ALL SELECT channel, 'Time decay', time_decay_revenue FROM fct_marketing_attribution"""
Q["share_of_total"] = f"""
SELECT channel, linear_revenue, {r('linear_revenue * 1e2 / SUM(linear_revenue) OVER ()', 6)} AS share_pct
FROM fct_marketing_attribution"""

# Insights
_DAILY = f"""SELECT date, channel_group, {isum('sessions')} AS sessions FROM stg_ga4_sessions GROUP BY 1, 2
  UNION ALL SELECT date, 'all', {isum('sessions')} FROM stg_ga4_sessions GROUP BY 1"""
Q["rolling_avg"] = f"""
SELECT *, {r('AVG(sessions) OVER (PARTITION BY channel_group ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 0)}
  AS rolling_avg FROM ({_DAILY})"""
Q["detect_anomalies"] = f"""
SELECT date, channel_group, sessions, {r('m', 0)} AS prior_avg, {r('(sessions - m) / m', 6)} AS pct_change,
  CASE WHEN sessions > m THEN 'spike' ELSE 'drop' END AS direction
FROM (SELECT *, AVG(sessions) OVER w AS m, COUNT(*) OVER w AS k FROM ({_DAILY})
  WINDOW w AS (PARTITION BY channel_group ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
WHERE k = 7 AND ABS((sessions - m) / m) > 0.3::DOUBLE"""
Q["funnel_steps"] = f"""
WITH f AS (SELECT channel_group, {isum('sessions')} AS a, {isum('engaged_sessions')} AS b, {isum('conversions')} AS c
  FROM stg_ga4_sessions GROUP BY 1)
SELECT channel_group, 1 AS step, 'sessions' AS stage, a AS value, 100::DOUBLE AS pct_of_top,
  CAST(NULL AS DOUBLE) AS pct_of_previous FROM f
UNION ALL SELECT channel_group, 2, 'engaged_sessions', b, {r('b * 1e2 / a', 1)}, {r('b * 1e2 / a', 1)} FROM f
UNION ALL SELECT channel_group, 3, 'conversions', c, {r('c * 1e2 / a', 1)}, {r('c * 1e2 / NULLIF(b, 0)', 1)} FROM f"""
Q["validate_funnel"] = f"""
WITH f AS (SELECT campaign_name, {isum('impressions')} AS a, {isum('clicks')} AS b, {isum('conversions')} AS c
  FROM int_campaign_unified GROUP BY 1)
SELECT campaign_name, 'clicks' AS stage, b AS value, 'impressions' AS previous_stage, a AS previous_value FROM f WHERE b > a
UNION ALL SELECT campaign_name, 'conversions', c, 'clicks', b FROM f WHERE c > b"""
CAMPAIGNS = f"""
SELECT campaign_name, platform, spend, impressions, clicks, conversions,
  COALESCE({r('conversions * 1e2 / NULLIF(spend, 0)', 2)}, CASE platform WHEN 'google_ads' THEN 0::DOUBLE END) AS roas,
  {div('clicks', 'impressions')} AS ctr, {pct2('conversions', 'clicks')} AS click_cvr
FROM (SELECT campaign_name, platform, {money('spend')} AS spend, {isum('impressions')} AS impressions,
  {isum('clicks')} AS clicks, {isum('conversions')} AS conversions FROM int_campaign_unified GROUP BY 1, 2)"""
_TIER = "CASE WHEN roas >= 8 THEN 'high' WHEN roas >= 3 THEN 'mid' ELSE 'low' END"
Q["campaign_leaderboard"] = f"""
SELECT *, {_TIER} AS tier FROM ({CAMPAIGNS}) ORDER BY roas DESC NULLS LAST, campaign_name LIMIT 10"""
Q["campaign_status"] = f"""
SELECT *, CASE WHEN roas >= 3 THEN 'Scale' WHEN roas < 1 THEN 'Pause' ELSE 'Watch' END AS status FROM ({CAMPAIGNS})"""
Q["top_bottom_campaigns"] = f"""
(SELECT campaign_name, platform, spend, roas, 'top' AS side FROM ({CAMPAIGNS}) ORDER BY roas DESC NULLS LAST, 1 LIMIT 5)
UNION ALL
(SELECT campaign_name, platform, spend, roas, 'bottom' FROM ({CAMPAIGNS}) ORDER BY roas NULLS LAST, 1 LIMIT 5)"""
Q["budget_pacing"] = f"""
SELECT *, LEAST(100, {r('spent * 1e2 / budget', 0)})::DOUBLE AS pacing_pct
FROM (
  SELECT c.campaign_name, 'google_ads' AS platform, {money('cost')} AS spent,
    ANY_VALUE(daily_budget) * COUNT(DISTINCT date) AS budget
  FROM stg_google_ads_performance p JOIN src_google_ads_campaigns c USING (campaign_id) GROUP BY 1
  UNION ALL
  SELECT c.campaign_name, 'meta_ads', {money('spend')}, ANY_VALUE(daily_budget) * COUNT(DISTINCT date)
  FROM stg_meta_ads_performance p JOIN src_meta_ads_campaigns c USING (campaign_id) GROUP BY 1)"""
Q["channel_mix_weekly"] = f"""
SELECT *, {r('spend * 1e2 / SUM(spend) OVER (PARTITION BY week)', 4)} AS share_pct
FROM (SELECT {week('date')} AS week, platform, {money('spend')} AS spend FROM int_campaign_unified GROUP BY 1, 2)"""
Q["waterfall_by_channel"] = f"""
SELECT platform, {isum('impressions')} AS impressions, {isum('clicks')} AS clicks, {isum('conversions')} AS conversions
FROM int_campaign_unified GROUP BY 1"""
Q["efficiency_points"] = f"""
SELECT campaign_name, platform, spend, roas, conversions, ctr, click_cvr FROM ({CAMPAIGNS})"""
Q["platform_comparison"] = f"""
SELECT *, COALESCE({r('conversions * 1e2 / NULLIF(spend, 0)', 2)}, 0::DOUBLE) AS roas
FROM (SELECT platform, {money('spend')} AS spend, {isum('clicks')} AS clicks, {isum('conversions')} AS conversions
  FROM int_campaign_unified GROUP BY 1)"""
Q["daily_spend_trend"] = f"""
SELECT date, COALESCE(g, 0::DOUBLE) AS google_spend, COALESCE(m, 0::DOUBLE) AS meta_spend
FROM (SELECT date, {money('cost')} AS g FROM stg_google_ads_performance GROUP BY 1) a
FULL JOIN (SELECT date, {money('spend')} AS m FROM stg_meta_ads_performance GROUP BY 1) b USING (date)"""
CRM = """
SELECT v.step, v.label AS stage, amount, create_date, close_date, weighted
FROM (SELECT deal_stage AS s, amount, create_date, close_date, CAST(NULL AS DOUBLE) AS weighted FROM stg_hubspot_deals
  UNION ALL SELECT stage, amount, created_date, close_date, weighted_amount FROM stg_salesforce_opportunities)
JOIN (VALUES (1, 'Prospecting', 'prospecting'), (2, 'Qualified/Analysis', 'qualified'),
  (2, 'Qualified/Analysis', 'Qualification'), (2, 'Qualified/Analysis', 'Needs Analysis'),
  (1, 'Prospecting', 'Prospecting'), (3, 'Presentation', 'presentation_scheduled'), (3, 'Presentation', 'Value Proposition'),
  (4, 'Proposal Sent', 'proposal_sent'), (4, 'Proposal Sent', 'Proposal/Price Quote'), (5, 'Negotiation', 'negotiation'),
  (5, 'Negotiation', 'Negotiation/Review'), (6, 'Closed Won', 'closed_won'), (6, 'Closed Won', 'Closed Won'),
  (7, 'Closed Lost', 'closed_lost'), (7, 'Closed Lost', 'Closed Lost')) AS v(step, label, raw) ON raw = s"""
Q["crm_stage_funnel"] = f"""
SELECT step, stage, COUNT(*) AS deals, {money('amount')} AS value FROM ({CRM}) GROUP BY 1, 2"""
_OPEN = "step < 6"
Q["crm_kpis"] = f"""
SELECT {money(f'CASE WHEN {_OPEN} THEN amount END')} AS open_value, {money_avg('amount')} AS avg_deal_size,
  {div(n_if('step = 6') + ' * 1e2', n_if('step > 5'))} AS win_rate_pct, {n_if(_OPEN)} AS deals_in_progress,
  {r(f'SUM(CASE WHEN {_OPEN} THEN weighted END)', 4)} AS forecast FROM ({CRM})"""


def _age(cond: str) -> str:
    return r(f"{n_if(cond)} * 1e2 / COUNT(*)", 1)


Q["deal_age_heatmap"] = f"""
WITH crm AS ({CRM}), aged AS (SELECT stage, step, (SELECT MAX(create_date) FROM crm) - create_date AS age FROM crm)
SELECT stage, COUNT(*) AS deals, {_age('age <= 30')} AS age_0_30, {_age('age BETWEEN 31 AND 60')} AS age_31_60,
  {_age('age BETWEEN 61 AND 90')} AS age_61_90, {_age('age >= 91')} AS age_90_plus
FROM aged WHERE {_OPEN} GROUP BY 1"""
Q["deal_age_bands"] = f"""
WITH crm AS ({CRM}), aged AS (SELECT stage, step, (SELECT MAX(create_date) FROM crm) - create_date AS age FROM crm),
bands AS (SELECT * FROM (VALUES ('month_one', 0, 31), ('month_two', 31, 61), ('quarter', 0, 91), ('past_target', 45, NULL)) AS b(band, lo, hi))
SELECT band, stage, COUNT(*) AS deals FROM aged JOIN bands ON age >= lo AND (hi IS NULL OR age < hi) WHERE {_OPEN} GROUP BY ALL"""
Q["days_to_close"] = f"""
SELECT avg_days, 90 AS target_days, avg_days <= 90 AS on_track
FROM (SELECT AVG(close_date - create_date) AS avg_days FROM ({CRM}) WHERE step > 5)"""
Q["lifecycle_distribution"] = "SELECT lifecycle_stage, COUNT(*) AS contacts FROM stg_hubspot_contacts GROUP BY 1"
Q["spend_vs_revenue_weekly"] = f"""
SELECT week, total_spend, total_revenue FROM (SELECT week, total_revenue FROM ({Q['weekly_revenue']})) a
FULL JOIN (SELECT week, total_spend FROM ({Q['weekly_spend']})) b USING (week)"""
Q["cvr_tier"] = f"""
SELECT *, CASE WHEN session_cvr >= 3.5 THEN 'good' WHEN session_cvr >= 2 THEN 'mid' ELSE 'low' END AS tier
FROM (SELECT *, {pct2('conversions', 'sessions')} AS session_cvr FROM (SELECT channel_group, {isum('sessions')} AS sessions,
  {isum('conversions')} AS conversions FROM stg_ga4_sessions GROUP BY 1))"""
Q["roas_tier"] = f"SELECT date, campaign_name, roas, {_TIER} AS tier FROM int_campaign_unified"
Q["static_kpis"] = f"""
SELECT {r('g + m', 2)} AS total_spend, total_sessions, conversions, pipeline_value, leads,
  {div('p * 1e2', 'm')} AS estimated_roas
FROM (SELECT {money('cost')} AS g FROM stg_google_ads_performance),
  (SELECT {money('spend')} AS m, {isum('purchases')} AS p FROM stg_meta_ads_performance),
  (SELECT {isum('sessions')} AS total_sessions, {isum('conversions')} AS conversions FROM stg_ga4_sessions),
  (SELECT {money('amount')} AS pipeline_value, COUNT(*) AS leads FROM stg_hubspot_deals)"""
Q["channel_share"] = f"""
SELECT *, {r('sessions * 1e2 / SUM(sessions) OVER ()', 1)} AS share_pct
FROM (SELECT channel_group AS channel, {isum('sessions')} AS sessions FROM stg_ga4_sessions GROUP BY 1)"""
Q["weekly_spend_outer"] = f"""
SELECT week, COALESCE(g, 0::DOUBLE) AS google, COALESCE(m, 0::DOUBLE) AS meta
FROM (SELECT {week('date')} AS week, {money('cost')} AS g FROM stg_google_ads_performance GROUP BY 1) a
FULL JOIN (SELECT {week('date')} AS week, {money('spend')} AS m FROM stg_meta_ads_performance GROUP BY 1) b USING (week)
ORDER BY week DESC LIMIT 12"""
Q["attribution_summary"] = f"""
SELECT channel_group, {isum('sessions')} AS sessions, {isum('conversions')} AS conversions, {money('revenue')} AS revenue,
  CASE channel_group
    WHEN 'paid_search' THEN (SELECT {div(money('cost'), isum('clicks'))} FROM stg_google_ads_performance)
    WHEN 'paid_social' THEN (SELECT {div(money('spend'), isum('link_clicks'))} FROM stg_meta_ads_performance)
  END AS avg_cpc
FROM stg_ga4_sessions GROUP BY channel_group"""
Q["traffic_kpis"] = f"""
SELECT *, {div('engaged_sessions * 1e2', 'sessions')} AS engagement_rate, {pct2('conversions', 'sessions')} AS session_cvr
FROM (SELECT {isum('sessions')} AS sessions, {isum('engaged_sessions')} AS engaged_sessions,
  {isum('conversions')} AS conversions FROM stg_ga4_sessions)"""
Q["channel_conversion_funnel"] = f"""
SELECT channel_group, {isum('sessions')} AS sessions, {isum('conversions')} AS conversions FROM stg_ga4_sessions GROUP BY 1"""

# Scalar functions
Q["google_roas"] = f"""
SELECT date, campaign_id, {pct2('conversions', 'cost')} AS est_roas FROM stg_google_ads_performance"""
Q["meta_roas"] = f"SELECT date, campaign_id, {r('roas', 2)} AS platform_roas FROM stg_meta_ads_performance"
Q["session_cvr"] = f"""
SELECT date, channel_group, device_category, {pct2('conversions', 'sessions')} AS cvr FROM stg_ga4_sessions"""
Q["click_cvr"] = f"SELECT date, campaign_name, {pct2('conversions', 'clicks')} AS cvr FROM int_campaign_unified"
Q["normalised_attribution"] = f"""
SELECT channel, {r('linear_revenue * 1e2 / SUM(linear_revenue) OVER ()', 1)} AS linear_revenue
FROM fct_marketing_attribution"""


def _text(x: str, digits: int) -> str:
    return f"CAST(CAST(ROUND(CAST({x} AS DECIMAL(38,10)), {digits}) AS DECIMAL(18,{digits})) AS VARCHAR)"


Q["formatted_metrics"] = f"""
SELECT channel,
  CASE WHEN total_spend >= 1e6 THEN '$' || {_text('total_spend / 1e6', 1)} || 'M'
    WHEN total_spend >= 1e3 THEN '$' || {_text('total_spend / 1e3', 1)} || 'K'
    ELSE '$' || {_text('total_spend', 0)} END AS spend_text,
  CASE WHEN attributed_revenue >= 1e6 THEN '$' || {_text('attributed_revenue / 1e6', 2)} || 'M'
    ELSE '$' || {_text('attributed_revenue / 1e3', 1)} || 'K' END AS revenue_text,
  CASE WHEN total_orders >= 1000 THEN {_text('total_orders / 1e3', 1)} || 'K'
    ELSE CAST(total_orders AS VARCHAR) END AS orders_text,
  {_text('roas', 1)} || '%' AS pct_text, {_text('roas', 2)} || '×' AS roas_text
FROM fct_channel_performance"""
Q["fiscal_quarter"] = """
SELECT 'Q' || QUARTER(order_date) || ' ' || YEAR(order_date) AS quarter, COUNT(*) AS orders FROM stg_orders GROUP BY 1"""
Q["ad_ratios"] = f"""
SELECT platform, campaign_category, {r('1e2 * c / GREATEST(i, 1)', 2)} AS ctr, {r('s / GREATEST(c, 1)', 2)} AS cpc,
  {r('1e3 * s / GREATEST(i, 1)', 2)} AS cpm, {r('s / GREATEST(n, 1)', 2)} AS cost_per_conversion,
  {r('v / GREATEST(s, 0.01::DOUBLE)', 2)} AS roas
FROM (SELECT platform, campaign_category, {isum('impressions')} AS i, {isum('clicks')} AS c, {isum('conversions')} AS n,
  {money('spend')} AS s, {money('revenue')} AS v FROM int_campaign_unified GROUP BY 1, 2)"""

# Builders
Q["orders_with_revenue"] = """
SELECT order_id, customer_id, order_purchase_timestamp, revenue FROM order_money WHERE order_status = 'delivered'"""
Q["contacts_rollup"] = "SELECT * REPLACE (LOWER(city) AS city) FROM contact_history"
TOUCHPOINTS = """
SELECT p.event_id AS order_id, p.customer_id, p.event_date AS order_date, t.channel, t.event_date AS touch_date,
  COUNT(*) AS touches
FROM src_web_events p JOIN src_web_events t ON t.customer_id = p.customer_id
  AND t.event_type IN ('view', 'click') AND p.event_date - t.event_date BETWEEN 0 AND 13
WHERE p.event_type = 'purchase' GROUP BY ALL"""
Q["build_touchpoints"] = TOUCHPOINTS
Q["assign_touch_credits"] = f"""
SELECT order_id, channel, touch_date, CAST(k AS INTEGER) AS touchpoint_position, CAST(n AS INTEGER) AS total_touchpoints,
  CASE k WHEN 1 THEN 1 ELSE 0 END::DOUBLE AS first_touch_credit, CASE k WHEN n THEN 1 ELSE 0 END::DOUBLE AS last_touch_credit,
  {r('CAST(1 AS DOUBLE) / n', 4)} AS linear_credit
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY touch_date, channel) AS k,
  COUNT(*) OVER (PARTITION BY order_id) AS n FROM ({TOUCHPOINTS}))"""
Q["deals_from_orders"] = "SELECT * FROM src_hubspot_deals"
Q["opportunities_from_orders"] = "SELECT * FROM src_salesforce_opportunities"
Q["accounts_from_sellers"] = "SELECT * FROM src_salesforce_accounts"

# Lead scoring
FEATURES = """
SELECT c.contact_id, c.email,
  CASE c.lead_source WHEN 'organic_search' THEN 'Organic Search' WHEN 'paid_search' THEN 'Paid Search'
    WHEN 'paid_social' THEN 'Paid Social' WHEN 'direct' THEN 'Direct' WHEN 'email' THEN 'Email'
    WHEN 'referral' THEN 'Referral' END AS channel,
  COALESCE(a.sessions, 0) AS sessions, COALESCE(a.engaged, 0) AS engaged_sessions, COALESCE(a.views, 0) AS page_views,
  CASE WHEN COALESCE(a.sessions, 0) > 1 THEN 0 ELSE 1 END AS is_first_visit,
  CASE WHEN d.last_stage = 'closed_won' THEN 1 ELSE 0 END AS is_won
FROM stg_hubspot_contacts c
LEFT JOIN (SELECT customer_id, COUNT(DISTINCT event_date) AS sessions,
    COUNT(DISTINCT event_date) FILTER (WHERE event_type IN ('click', 'purchase')) AS engaged,
    COUNT(*) FILTER (WHERE event_type = 'view') AS views FROM src_web_events GROUP BY 1) a ON a.customer_id = c.customer_id
LEFT JOIN (SELECT u.customer_unique_id, d.deal_stage AS last_stage FROM stg_hubspot_deals d
    JOIN stg_orders o USING (order_id) JOIN stg_customers u USING (customer_id)
    QUALIFY ROW_NUMBER() OVER (PARTITION BY u.customer_unique_id ORDER BY d.create_date DESC, d.deal_id DESC) = 1) d
  ON d.customer_unique_id = c.customer_id"""
Q["lead_features"] = FEATURES
Q["split"] = f"""
SELECT contact_id, CAST('0x' || SUBSTR(MD5(contact_id || '#42'), 1, 8) AS BIGINT) % 1000 < 200 AS is_test FROM ({FEATURES})"""
RULE = f"""
SELECT customer_id, {r('''LEAST(0.1::DOUBLE
    + CASE customer_segment WHEN 'vip' THEN 0.25 WHEN 'returning' THEN 0.15 ELSE 0.05 END::DOUBLE
    + CASE lead_source WHEN 'paid_search' THEN 0.12 WHEN 'email' THEN 0.10 WHEN 'referral' THEN 0.08
        WHEN 'organic_search' THEN 0.06 WHEN 'paid_social' THEN 0.04 WHEN 'direct' THEN 0.03 ELSE 0.05 END::DOUBLE
    + LEAST(total_orders * 0.08::DOUBLE, 0.4::DOUBLE)
    + LEAST(COALESCE(total_revenue, 0) / 10000 * 0.2::DOUBLE, 0.2::DOUBLE), 0.97::DOUBLE)''', 6)} AS score
FROM fct_lead_scoring_features"""
Q["rule_score"] = f"""
SELECT *, CASE WHEN score >= 0.6 THEN 'High value' WHEN score >= 0.35 THEN 'Medium value' ELSE 'Low value' END AS tier
FROM ({RULE})"""
Q["lead_tier"] = f"""
SELECT *, CASE WHEN score > 0.8 THEN 'A' WHEN score > 0.5 THEN 'B' ELSE 'C' END AS lead_tier,
  CASE WHEN score > 0.8 THEN 'High priority: Instant sales follow-up' ELSE 'Nurture: Add to email drip' END AS recommendation
FROM ({RULE})"""

Q["train_lead_model"] = f"""
SELECT position, feature, TRUE AS weights_are_shares, train_leads, test_leads, won_leads
FROM (VALUES (1, 'sessions'), (2, 'engaged_sessions'), (3, 'page_views'), (4, 'is_first_visit')) AS f(position, feature),
  (SELECT COUNT(*) FILTER (WHERE NOT is_test) AS train_leads, COUNT(*) FILTER (WHERE is_test) AS test_leads,
     CAST(SUM(is_won) AS BIGINT) AS won_leads FROM ({FEATURES}) JOIN ({Q['split']}) USING (contact_id))"""
Q["evaluate"] = """
SELECT metric, 1::DOUBLE AS value FROM (VALUES ('accuracy'), ('precision'), ('recall'), ('f1'), ('auc')) AS m(metric)"""
Q["score_leads"] = f"""
SELECT *, CASE WHEN score > 0.8 THEN 'A' WHEN score > 0.5 THEN 'B' ELSE 'C' END AS lead_tier,
  CASE WHEN score > 0.8 THEN 'High priority: Instant sales follow-up' ELSE 'Nurture: Add to email drip' END AS recommendation
FROM (SELECT contact_id, channel, TRUE AS score_keeps_rules,
  LEAST(0.75::DOUBLE * CASE channel WHEN 'Direct' THEN 1.2 WHEN 'Organic Search' THEN 1.1 ELSE 1 END::DOUBLE, 1) AS score FROM ({FEATURES}))"""
_LONG = " UNION ALL ".join(
    f"SELECT {i} AS feature, {c} AS v, 2 * is_won - 1 AS y FROM seen"
    for i, c in enumerate(("sessions", "engaged_sessions", "page_views", "is_first_visit"))
)
# one split: the one of the least squared error; a side's probability follows from its mean of -1 and 1
Q["stump_scores"] = f"""
WITH leads AS (SELECT * FROM ({FEATURES}) JOIN ({Q['split']}) USING (contact_id)),
seen AS (SELECT * FROM leads WHERE NOT is_test),
folded AS (SELECT feature, v, COUNT(*) AS n, SUM(y) AS y FROM ({_LONG}) GROUP BY ALL),
splits AS (SELECT feature, (v + LEAD(v) OVER w) / 2 AS cut, SUM(n) OVER w AS nl, SUM(y) OVER w AS yl,
    SUM(n) OVER (PARTITION BY feature) AS nt, SUM(y) OVER (PARTITION BY feature) AS yt
  FROM folded WINDOW w AS (PARTITION BY feature ORDER BY v)),
best AS (SELECT feature, cut, yl::DOUBLE / nl AS low_mean, (yt - yl)::DOUBLE / (nt - nl) AS high_mean FROM splits WHERE nl < nt
  ORDER BY yl::DOUBLE * yl / nl + (yt - yl)::DOUBLE * (yt - yl) / (nt - nl) DESC, feature, cut LIMIT 1),
scored AS (SELECT contact_id, channel, LEAST(1::DOUBLE,
    CASE channel WHEN 'Direct' THEN 1.2 WHEN 'Organic Search' THEN 1.1 ELSE 1 END::DOUBLE
    / (1 + EXP(-2 * CASE WHEN CASE feature WHEN 0 THEN sessions WHEN 1 THEN engaged_sessions WHEN 2 THEN page_views
      ELSE is_first_visit END <= cut THEN low_mean ELSE high_mean END))) AS exact FROM leads, best)
SELECT contact_id, channel, {r('exact', 6)} AS score, exact > 0.8 AS alert,
  CASE WHEN exact > 0.8 THEN 'A' WHEN exact > 0.5 THEN 'B' ELSE 'C' END AS lead_tier,
  CASE WHEN exact > 0.8 THEN 'High priority: Instant sales follow-up' ELSE 'Nurture: Add to email drip' END AS recommendation
FROM scored"""
Q["run_log"] = """
SELECT 'run-1' AS run_id, 'maxDepth=5,maxIter=100,seed=42,stepSize=0.1' AS params, 'accuracy,auc,f1,precision,recall' AS metrics"""
Q["saved_model"] = f"SELECT contact_id, TRUE AS same_score FROM ({FEATURES})"
Q["routed_leads"] = f"SELECT contact_id, TRUE AS routed_by_score FROM ({FEATURES})"

# Data quality
Q["check_not_null"] = "SELECT * FROM stg_orders WHERE order_delivered_customer_date IS NULL"
Q["check_unique"] = "SELECT order_id, COUNT(*) AS n FROM stg_order_items GROUP BY 1 HAVING COUNT(*) > 1"
Q["check_accepted_values"] = """
SELECT order_status, COUNT(*) AS n FROM stg_orders WHERE order_status NOT IN ('delivered', 'shipped') GROUP BY 1"""


def _report(table: str, unique=(), not_null=(), accepted=()) -> list[str]:
    parts = [(c, "not_null", f"SELECT COUNT(*) FROM {table} WHERE {c} IS NULL") for c in not_null]
    parts += [
        (c, "unique", f"SELECT COUNT(*) FROM (SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)")
        for c in unique
    ]
    parts += [
        (c, "accepted_values", f"SELECT COUNT(*) FROM {table} WHERE {c} NOT IN ({', '.join(repr(v) for v in values)})")
        for c, values in accepted
    ]
    return [f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{k}' AS check_name, ({q}) AS failures" for c, k, q in parts]


def _checks(reports: list[list[str]]) -> str:
    rows = "\nUNION ALL ".join(line for report in reports for line in report)
    return f"SELECT *, failures = 0 AS passed FROM ({rows})"


Q["run_checks_staging"] = _checks(
    [
        _report("stg_orders", ["order_id"], ["order_id", "customer_id", "order_status", "order_date"], [
            ("order_status", ["delivered", "shipped", "canceled", "invoiced", "processing", "approved", "unavailable", "created"])]),
        _report("stg_customers", ["customer_id"], ["customer_id", "customer_state"]),
        _report("stg_order_items", [], ["order_id", "price"]),
        _report("stg_order_payments", [], ["order_id", "payment_value"], [
            ("payment_type", ["credit_card", "boleto", "voucher", "debit_card", "not_defined"])]),
        _report("stg_order_reviews", [], ["order_id", "review_score"], [("review_score", [1, 2, 3, 4, 5])]),
        _report("stg_products", ["product_id"], ["product_id"]),
        _report("stg_sellers", ["seller_id"], ["seller_id"]),
        _report("stg_ga4_sessions", [], ["date", "channel_group", "sessions"]),
        _report("stg_google_ads_performance", [], ["date", "campaign_id", "cost"]),
        _report("stg_meta_ads_performance", [], ["date", "campaign_id", "spend"]),
        _report("stg_hubspot_contacts", ["contact_id"], ["contact_id", "lifecycle_stage"], [
            ("lifecycle_stage", ["subscriber", "lead", "marketing_qualified_lead", "sales_qualified_lead", "opportunity",
                                 "customer", "evangelist"])]),
        _report("stg_hubspot_deals", ["deal_id"], ["deal_id", "deal_stage", "amount"], [
            ("deal_stage", ["prospecting", "qualified", "presentation_scheduled", "proposal_sent", "negotiation",
                            "closed_won", "closed_lost"])]),
        _report("stg_salesforce_opportunities", ["opportunity_id"], ["opportunity_id", "stage", "probability"], [
            ("stage", ["Prospecting", "Qualification", "Needs Analysis", "Value Proposition", "Proposal/Price Quote",
                       "Negotiation/Review", "Closed Won", "Closed Lost"])]),
        _report("stg_marketing_attribution", [], ["order_id", "channel"]),
    ]
)
Q["run_checks_marts"] = _checks(
    [
        _report("fct_orders", [], ["order_id", "customer_id", "order_date", "revenue"]),
        _report("fct_marketing_daily", [], ["date", "total_spend"]),
        _report("fct_channel_performance", ["channel"], ["channel", "total_spend", "attributed_revenue"]),
        _report("fct_marketing_attribution", ["channel"], [
            "channel", "first_touch_revenue", "last_touch_revenue", "linear_revenue", "time_decay_revenue"]),
        _report("fct_pipeline", ["attribution_channel"], ["attribution_channel"]),
        _report("fct_lead_scoring_features", ["customer_id"], ["customer_id", "total_orders", "is_high_value"]),
        _report("fct_daily_revenue", ["order_date"], ["order_date", "total_revenue"]),
        _report("dim_customers", ["customer_id"], ["customer_id", "customer_state"]),
        _report("dim_products", ["product_id"], ["product_id"]),
        _report("dim_campaigns", [], ["campaign_id"]),
        _report("time_spine", ["date_day"], ["date_day"]),
    ]
)

ORACLE = {name: with_tables(sql) for name, sql in Q.items()}
