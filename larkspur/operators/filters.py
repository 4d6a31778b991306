"""Projections, filters, distinct lists and top-k reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.dates import period_start
from larkspur.sources.schemas import PRIMARY_KEYS
from larkspur.sources.tables import Tables


def row_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("row_count"))


def preview(rows: DataFrame, key: str, n: int | None = 10) -> DataFrame:
    """First ``n`` rows by key, or every row when ``n`` is None."""
    return rows if n is None else rows.orderBy(key).limit(n)


def recent_completed_orders(t: Tables, n: int = 10) -> DataFrame:
    """Newest completed orders.  The order id decides between orders of one day, so the list is repeatable."""
    newest = t.orders.where(F.col("order_status") == "completed").orderBy(F.desc("order_date"), "order_id").limit(n)
    return newest.select("order_id", "customer_id", "order_date", "product_name", "total_amount")


def mobile_purchases(t: Tables, n: int = 15, event: str = "purchase", device: str = "mobile") -> DataFrame:
    """Oldest events of one kind on one device."""
    wanted = (F.col("event_name") == event) & (F.col("device_category") == device)
    return t.ga4_events.where(wanted).orderBy("event_date", "event_id").limit(n)


def top_churn_risk(t: Tables, n: int = 10) -> DataFrame:
    """Customers most likely to churn; those without a score come last."""
    ranked = t.customer_scores.orderBy(F.col("churn_risk_score").desc_nulls_last(), PRIMARY_KEYS["customer_scores"])
    return ranked.limit(n)


def checkout_eligible_customers(t: Tables) -> DataFrame:
    """Known customers who began a checkout at least once: the population of a checkout experiment."""
    began = t.ga4_events.where((F.col("event_name") == "begin_checkout") & F.col("customer_id").isNotNull())
    return began.select("customer_id").distinct()


def saas_eligible_customers(t: Tables) -> DataFrame:
    return t.customers.where(F.col("customer_type").isin("saas", "both")).select("customer_id", "signup_date")


def purchase_events(t: Tables) -> DataFrame:
    return t.ga4_events.where(F.col("event_name") == "purchase").select("customer_id", "event_date")


def activity_periods(rows: DataFrame, day: str, grain: str = "month", label: str = "activity_month") -> DataFrame:
    """Distinct (customer, period) pairs; rows without a customer leave one NULL row per period."""
    return rows.select("customer_id", period_start(F.col(day), grain).alias(label)).distinct()


def monthly_activity(t: Tables, grain: str = "month") -> DataFrame:
    return activity_periods(t.ga4_events, "event_date", grain)


def monthly_activity_head(t: Tables, n: int = 20, grain: str = "month") -> DataFrame:
    ordered = monthly_activity(t, grain).orderBy(F.col("customer_id").asc_nulls_last(), "activity_month")
    return ordered.limit(n)


def customer_channel_dates(t: Tables) -> DataFrame:
    return t.customers.select("customer_id", "acquisition_channel", "signup_date")


def customer_signup_dates(t: Tables) -> DataFrame:
    return t.customers.select("customer_id", "signup_date")
