"""Feature tables.  Facts are summed per customer before any join, so events and messages never multiply."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.dates import months_until, whole_months
from larkspur.operators.aggregates import browse_stats, event_activity, message_engagement
from larkspur.operators.joins import buyers
from larkspur.operators.scale import skew_safe_join
from larkspur.plans.metrics import with_value
from larkspur.sources.tables import Tables

_MESSAGES = {
    "total_sent": "crm_emails_sent",
    "total_opened": "crm_emails_opened",
    "total_clicked": "crm_emails_clicked",
}


def _or_zero(*names: str) -> list:
    return [F.coalesce(F.col(name), F.lit(0)).alias(name) for name in names]


def _messages(t: Tables) -> DataFrame:
    return message_engagement(t).withColumnsRenamed(_MESSAGES)


def _with_activity(people: DataFrame, t: Tables) -> DataFrame:
    """``people`` with event and message totals, 0 where a customer appears in neither log."""
    joined = people.join(event_activity(t), "customer_id", "left").join(_messages(t), "customer_id", "left")
    return joined.select(*people.columns, *_or_zero("total_events", "active_days", *_MESSAGES.values()))


def feature_left_joins(t: Tables) -> DataFrame:
    return _with_activity(t.customers.select("customer_id"), t)


def engagement_rate(rows: DataFrame) -> DataFrame:
    """Active days per month of tenure; a tenure of zero months counts as one."""
    months = F.when(F.col("tenure_months") == 0, 1).otherwise(F.col("tenure_months"))
    return rows.withColumn("engagement_rate", F.col("active_days").cast("double") / months)


def _subscription_features(t: Tables, as_of: date, statuses: tuple[str, ...]) -> DataFrame:
    """One row per subscription with the features of its customer.

    The customer side is built first, one row per customer; the subscriptions join last, so a customer holding very
    many of them can be spread over tasks.
    """
    also_shop = F.when(F.col("customer_type") == "both", 1).otherwise(0).alias("also_ecommerce")
    people = _with_activity(t.customers.select("customer_id", also_shop), t)
    subs = t.subscriptions.where(F.col("status").isin(*statuses) & F.col("customer_id").isNotNull()).select(
        "subscription_id", "customer_id", "plan_name", "start_date", "end_date", "mrr", "status"
    )
    joined = skew_safe_join(subs, people, ["customer_id"], spread=["subscription_id"])
    tenure = months_until(F.col("start_date"), F.col("end_date"), as_of)
    return engagement_rate(joined.withColumn("tenure_months", tenure))


_CHURN_COLUMNS = (
    "customer_id",
    "plan_name",
    "tenure_months",
    "mrr",
    "total_events",
    "active_days",
    *_MESSAGES.values(),
    "also_ecommerce",
    "engagement_rate",
)


def churn_features(t: Tables, as_of: date, keep_id: bool = False) -> DataFrame:
    """Training rows: one per active or cancelled subscription; ``churned`` marks the cancelled ones.

    ``keep_id`` adds the subscription id in front, for steps that need a unique key per row.
    """
    rows = _subscription_features(t, as_of, ("active", "cancelled"))
    churned = F.when(F.col("status") == "cancelled", 1).otherwise(0).alias("churned")
    return rows.select(*(["subscription_id"] if keep_id else []), *_CHURN_COLUMNS, churned)


def churn_scoring_features(t: Tables, as_of: date, compat_zero_fill: bool = False) -> DataFrame:
    """Rows to score: active subscriptions, the same features as in training.

    ``compat_zero_fill`` sets the engagement rate to 0 for everybody, as a scoring job does that never computes it.
    """
    rows = _subscription_features(t, as_of, ("active",)).select(*_CHURN_COLUMNS)
    return rows.withColumn("engagement_rate", F.lit(0.0)) if compat_zero_fill else rows


def propensity_scoring_features(t: Tables, as_of: date) -> DataFrame:
    """One row per customer: who they are, how they browse, how they react to messages."""
    people = t.customers.select(
        "customer_id",
        "acquisition_channel",
        "country",
        "customer_type",
        whole_months(F.col("signup_date"), F.lit(as_of)).alias("account_age_months"),
    )
    joined = people.join(browse_stats(t), "customer_id", "left").join(_messages(t), "customer_id", "left")
    share = F.coalesce("mobile_session_pct", F.lit(0).cast("decimal(10,1)")).cast("decimal(10,1)")
    return joined.select(
        *people.columns,
        *_or_zero("page_views", "view_item_events", "distinct_sessions"),
        share.alias("mobile_session_pct"),
        *_or_zero(*_MESSAGES.values()),
    )


def propensity_features(t: Tables, as_of: date) -> DataFrame:
    """Training rows: the scoring features and whether the customer ever completed an order."""
    flagged = buyers(t).withColumn("purchased", F.lit(1))
    joined = propensity_scoring_features(t, as_of).join(flagged, "customer_id", "left")
    return joined.withColumn("purchased", F.coalesce("purchased", F.lit(0)))


def ltv_features(t: Tables, as_of: date) -> DataFrame:
    """Training rows: the scoring features and the customer's value to date."""
    return with_value(propensity_scoring_features(t, as_of), t, as_of).drop("bought", "subscribed")


def log_target(rows: DataFrame, value: str = "total_ltv") -> DataFrame:
    """Add ``log_ltv``, the target in log scale, and ``back``, the value it maps back to."""
    logged = F.log1p(F.col(value).cast("double"))
    return rows.withColumn("log_ltv", logged).withColumn("back", F.expm1("log_ltv"))
