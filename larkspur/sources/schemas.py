"""Declared schemas, keys and vocabularies of the eight tables.  Nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind, nullable) for name, kind, nullable in fields])


_ID, _INT, _TEXT, _DATE, _FLAG = LongType(), IntegerType(), StringType(), DateType(), BooleanType()
_MONEY, _SCORE = DecimalType(10, 2), DecimalType(5, 4)

SCHEMAS: dict[str, StructType] = {
    "customers": _schema(
        ("customer_id", _ID, False),
        ("signup_date", _DATE, False),
        ("acquisition_channel", _TEXT, True),
        ("country", _TEXT, True),
        ("customer_type", _TEXT, True),
    ),
    "marketing_spend": _schema(
        ("spend_id", _ID, False),
        ("spend_date", _DATE, False),
        ("channel", _TEXT, False),
        ("campaign_name", _TEXT, True),
        ("impressions", _INT, True),
        ("clicks", _INT, True),
        ("cost", _MONEY, True),
        ("conversions", _INT, True),
    ),
    "ga4_events": _schema(
        ("event_id", _ID, False),
        ("customer_id", _ID, True),
        ("event_date", _DATE, False),
        ("event_name", _TEXT, True),
        ("page_path", _TEXT, True),
        ("session_id", _TEXT, True),
        ("traffic_source", _TEXT, True),
        ("device_category", _TEXT, True),
    ),
    "orders": _schema(
        ("order_id", _ID, False),
        ("customer_id", _ID, True),
        ("order_date", _DATE, False),
        ("product_name", _TEXT, True),
        ("quantity", _INT, True),
        ("unit_price", _MONEY, True),
        ("total_amount", _MONEY, True),
        ("order_status", _TEXT, True),
    ),
    "subscriptions": _schema(
        ("subscription_id", _ID, False),
        ("customer_id", _ID, True),
        ("plan_name", _TEXT, True),
        ("start_date", _DATE, False),
        ("end_date", _DATE, True),
        ("mrr", _MONEY, True),
        ("status", _TEXT, True),
    ),
    "crm_engagement": _schema(
        ("engagement_id", _ID, False),
        ("customer_id", _ID, True),
        ("campaign_name", _TEXT, True),
        ("channel", _TEXT, True),
        ("sent_date", _DATE, False),
        ("opened", _FLAG, True),
        ("clicked", _FLAG, True),
    ),
    "ab_test_assignments": _schema(
        ("assignment_id", _ID, False),
        ("customer_id", _ID, True),
        ("experiment_name", _TEXT, True),
        ("variant", _TEXT, True),
        ("assigned_date", _DATE, False),
        ("converted", _FLAG, True),
    ),
    "customer_scores": _schema(
        ("customer_id", _ID, False),
        ("churn_risk_score", _SCORE, True),
        ("purchase_propensity_score", _SCORE, True),
        ("predicted_ltv", _MONEY, True),
        ("scored_at", TimestampType(), False),
    ),
}

PRIMARY_KEYS: dict[str, str] = {
    "customers": "customer_id",
    "marketing_spend": "spend_id",
    "ga4_events": "event_id",
    "orders": "order_id",
    "subscriptions": "subscription_id",
    "crm_engagement": "engagement_id",
    "ab_test_assignments": "assignment_id",
    "customer_scores": "customer_id",
}

# Date columns worth partitioning stored tables by, so that year reports prune files.
STORAGE_DATES: dict[str, str] = {
    "marketing_spend": "spend_date",
    "ga4_events": "event_date",
    "orders": "order_date",
    "crm_engagement": "sent_date",
}

# The vocabularies the business uses.
VOCABULARY: dict[tuple[str, str], tuple[str, ...]] = {
    ("customers", "acquisition_channel"): ("Google", "Meta", "Organic", "Referral", "Direct", "Email"),
    ("customers", "country"): ("United States", "United Kingdom", "Nigeria", "Canada", "Germany", "India"),
    ("customers", "customer_type"): ("ecommerce", "saas", "both"),
    ("marketing_spend", "channel"): ("Google Ads", "Meta Ads"),
    ("ga4_events", "event_name"): ("page_view", "view_item", "add_to_cart", "begin_checkout", "purchase"),
    ("ga4_events", "device_category"): ("desktop", "mobile", "tablet"),
    ("orders", "product_name"): ("Starter Kit", "Pro Bundle", "Premium Set", "Accessory Pack", "Gift Card"),
    ("orders", "order_status"): ("completed", "refunded", "cancelled"),
    ("subscriptions", "plan_name"): ("Basic", "Pro", "Enterprise"),
    ("subscriptions", "status"): ("active", "cancelled", "paused"),
    ("crm_engagement", "campaign_name"): (
        "Welcome Series",
        "Cart Abandonment",
        "Weekly Newsletter",
        "Win-Back",
        "Product Announcement",
    ),
    ("crm_engagement", "channel"): ("email", "push", "sms"),
    ("ab_test_assignments", "variant"): ("A", "B"),
}
