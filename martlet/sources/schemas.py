"""Explicit schemas of the logical sources (read from CSV or parquet without inference)."""

from __future__ import annotations

from pyspark.sql.types import StructType

COMMERCE = {
    "orders": """order_id string, customer_id string, order_status string,
        order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,
        order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz,
        order_estimated_delivery_date timestamp_ntz""",
    "order_items": """order_id string, order_item_id int, product_id string, seller_id string,
        shipping_limit_date timestamp_ntz, price double, freight_value double""",
    "order_payments": """order_id string, payment_sequential int, payment_type string,
        payment_installments int, payment_value double""",
    "order_reviews": """review_id string, order_id string, review_score int,
        review_comment_title string, review_comment_message string,
        review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz""",
    "customers": """customer_id string, customer_unique_id string,
        customer_zip_code_prefix string, customer_city string, customer_state string""",
    "sellers": """seller_id string, seller_zip_code_prefix string, seller_city string,
        seller_state string""",
    "products": """product_id string, product_category_name string, product_name_lenght int,
        product_description_lenght int, product_photos_qty int, product_weight_g double,
        product_length_cm double, product_height_cm double, product_width_cm double""",
    "geolocation": """geolocation_zip_code_prefix string, geolocation_lat double,
        geolocation_lng double, geolocation_city string, geolocation_state string""",
    "category_translation": "product_category_name string, product_category_name_english string",
}

MARKETING = {
    "google_ads_daily_performance": """date date, campaign_id string, campaign_name string,
        campaign_type string, impressions long, clicks long, cost double, conversions long,
        conversion_value double, ctr double, avg_cpc double, cost_per_conversion double,
        roas double""",
    "google_ads_campaigns": """campaign_id string, campaign_name string, campaign_type string,
        daily_budget double""",
    "google_ads_ad_groups": "ad_group_id string, campaign_id string, ad_group_name string",
    "google_ads_keywords": "keyword_id string, ad_group_id string, keyword string, match_type string",
    "meta_ads_daily_performance": """date date, campaign_id string, campaign_name string,
        objective string, impressions long, reach long, spend double, link_clicks long,
        ctr double, cpc double, cpm double, purchases long, purchase_value double,
        cost_per_purchase double, roas double""",
    "meta_ads_campaigns": """campaign_id string, campaign_name string, objective string,
        daily_budget double""",
    "meta_ads_ad_sets": """ad_set_id string, campaign_id string, ad_set_name string,
        targeting string, placement string""",
    "ga4_daily_sessions": """date date, channel_group string, device_category string,
        sessions long, engaged_sessions long, bounce_rate double,
        avg_session_duration_sec double, pages_per_session double, new_users long,
        conversions long, revenue double, conversion_rate double""",
    "hubspot_contacts": """contact_id string, customer_id string, email string,
        first_name string, last_name string, city string, state string, create_date date,
        lifecycle_stage string, lead_source string, num_orders long, total_revenue double,
        first_order_date date, last_activity_date date""",
    "hubspot_deals": """deal_id string, order_id string, deal_name string, deal_stage string,
        pipeline string, amount double, create_date date, close_date string, deal_type string,
        lead_source string""",
    "salesforce_opportunities": """opportunity_id string, order_id string,
        opportunity_name string, stage string, probability int, amount double,
        created_date date, close_date date, lead_source string, type string,
        fiscal_quarter string""",
    "salesforce_accounts": """account_id string, seller_id string, account_name string,
        city string, state string, account_type string, industry string,
        annual_revenue double, num_employees int""",
    "marketing_attribution": """order_id string, touchpoint_position int,
        total_touchpoints int, channel string, platform string, touchpoint_date date,
        order_date date, order_revenue double, first_touch_credit double,
        last_touch_credit double, linear_credit double""",
}

LEADS = {
    "web_events": """event_id long, customer_id string, event_type string, channel string,
        event_date date, value double""",
    "web_hits": """event_id long, customer_id string, event_type string, channel string,
        ts timestamp, value double, props string""",
    "lead_scoring_features": """contact_id string, sessions long, engaged_sessions long,
        page_views long, is_first_visit int, is_won int""",
}

SCHEMAS = {**COMMERCE, **MARKETING, **LEADS}


def schema_of(name: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[name])
