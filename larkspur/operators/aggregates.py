"""Grouped counts and sums.  Every one combines on the map side, so a hot group costs one row per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.dates import month_name, year_month
from larkspur.functions.labels import BROWSE_STAGES, NO_CHURN_BAND, churn_band, channel_clean, propensity_band
from larkspur.functions.labels import stage_order
from larkspur.functions.money import as_count, percent, ratio, total
from larkspur.operators.scale import exact_percentiles
from larkspur.sources.tables import Tables


def _rows(alias: str) -> Column:
    return F.count(F.lit(1)).alias(alias)


def channel_totals(t: Tables) -> DataFrame:
    sums = t.marketing_spend.groupBy("channel").agg(
        total(F.col("cost")).alias("total_cost"), F.sum("conversions").alias("total_conversions")
    )
    return sums.orderBy(F.desc("total_cost"))


def popular_products(t: Tables, min_orders: int = 500) -> DataFrame:
    """Products ordered more than ``min_orders`` times, with the average order value."""
    per_product = t.orders.groupBy("product_name").agg(
        _rows("order_count"), F.avg("total_amount").alias("avg_total_amt")
    )
    return per_product.where(F.col("order_count") > min_orders)


def customers_by_country(t: Tables) -> DataFrame:
    return t.customers.groupBy("country").agg(_rows("num_customers")).orderBy(F.desc("num_customers"), "country")


def event_counts(t: Tables) -> DataFrame:
    return t.ga4_events.groupBy("event_name").agg(_rows("event_count")).orderBy(F.desc("event_count"), "event_name")


def _assignments(t: Tables, experiment: str | None) -> DataFrame:
    rows = t.ab_test_assignments
    return rows if experiment is None else rows.where(F.col("experiment_name") == experiment)


def variant_counts(t: Tables, experiment: str | None = None, *keys: Column) -> DataFrame:
    grouped = _assignments(t, experiment).groupBy(*keys, "variant")
    return grouped.agg(_rows("total_assigned"), F.sum(F.col("converted").cast("int")).alias("total_converted"))


def _with_rate(counts: DataFrame) -> DataFrame:
    rate = percent(F.col("total_converted"), F.col("total_assigned"), 2)
    return counts.withColumn("conversion_rate_pct", rate)


def variant_counts_by_year(t: Tables, experiment: str | None = None) -> DataFrame:
    return variant_counts(t, experiment, F.year("assigned_date").alias("year"))


def rates_all_time(counts: DataFrame) -> DataFrame:
    """Conversion per variant, from counts per variant or per year and variant."""
    sums = counts.groupBy("variant").agg(
        F.sum("total_assigned").alias("total_assigned"), F.sum("total_converted").alias("total_converted")
    )
    return _with_rate(sums).orderBy("variant")


def rates_by_year(counts: DataFrame) -> DataFrame:
    return _with_rate(counts).orderBy("year", "variant")


def ab_conversion(t: Tables, experiment: str | None = None) -> DataFrame:
    return _with_rate(variant_counts(t, experiment)).orderBy("variant")


def ab_conversion_by_year(t: Tables, experiment: str | None = None) -> DataFrame:
    return rates_by_year(variant_counts_by_year(t, experiment))


def customer_growth(t: Tables) -> DataFrame:
    """New customers per calendar month."""
    day = F.col("signup_date")
    keys = [F.year(day).alias("year"), month_name(day).alias("month"), F.month(day).alias("month_num")]
    return t.customers.groupBy(*keys).agg(_rows("customers")).orderBy("year", "month_num")


def monthly_platform_spend(t: Tables) -> DataFrame:
    """Spend measures per month and ad platform: a few rows per month that every spend report is built from."""
    keys = [F.trunc("spend_date", "month").alias("month_start"), F.col("channel").alias("platform")]
    return t.marketing_spend.groupBy(*keys).agg(
        total(F.col("cost")).alias("cost"),
        F.sum("clicks").alias("clicks"),
        F.sum("impressions").alias("impressions"),
        F.sum("conversions").alias("conversions"),
    )


def platform_trend(monthly: DataFrame) -> DataFrame:
    """Spend per month and platform.  Groups are the platforms as stored: two platforms without an acquisition
    channel give two rows that both show NULL."""
    month = F.col("month_start")
    return monthly.select(
        F.year(month).alias("year"),
        month_name(month).alias("month"),
        F.month(month).alias("month_num"),
        channel_clean(F.col("platform")).alias("channel"),
        F.col("cost").alias("spend"),
        "conversions",
    ).orderBy("year", "month_num", F.col("channel").asc_nulls_last(), "spend", "conversions")


def channel_trend(monthly: DataFrame) -> DataFrame:
    """Four monthly measures per acquisition channel.  Groups are the mapped names, so platforms without one merge.
    The measures are monthly sums although they are called daily."""
    keys = [F.col("month_start").alias("month_sort"), channel_clean(F.col("platform")).alias("channel_clean")]
    sums = monthly.groupBy(*keys).agg(
        total(F.col("cost")).alias("daily_cost"),
        *[F.sum(c).alias(f"daily_{c}") for c in ("clicks", "impressions", "conversions")],
    )
    shown = sums.select(year_month(F.col("month_sort")).alias("year_month"), *sums.columns)
    return shown.orderBy("month_sort", "channel_clean")


def spend_trend_by_channel(t: Tables) -> DataFrame:
    return platform_trend(monthly_platform_spend(t))


def spend_trend_monthly(t: Tables) -> DataFrame:
    return channel_trend(monthly_platform_spend(t))


def customer_breakdown(t: Tables) -> DataFrame:
    keys = ["acquisition_channel", "country", "customer_type"]
    return t.customers.groupBy(*keys).agg(_rows("customer_count")).orderBy(F.desc("customer_count"), *keys)


def event_counts_by_year(t: Tables) -> DataFrame:
    return t.ga4_events.groupBy(F.year("event_date").alias("year"), "event_name").agg(_rows("event_count"))


def funnel(counts: DataFrame, by_year: bool) -> DataFrame:
    """Events per stage with the place of the stage, from counts per year and event; unknown events come last
    without a place."""
    keys = ["year"] if by_year else []
    sums = counts.groupBy(*keys, "event_name").agg(F.sum("event_count").alias("event_count"))
    placed = sums.withColumn("stage_order", stage_order(F.col("event_name")))
    return placed.orderBy(*keys, F.col("stage_order").asc_nulls_last(), "event_name")


def funnel_by_year(t: Tables) -> DataFrame:
    return funnel(event_counts_by_year(t), by_year=True)


def funnel_all_time(t: Tables) -> DataFrame:
    return funnel(event_counts_by_year(t), by_year=False)


def _mean_prediction() -> Column:
    return ratio(F.sum("predicted_ltv"), F.count("predicted_ltv")).alias("avg_predicted_ltv")


def risk_propensity_bands(t: Tables, high: str = "0.5", medium: str = "0.3") -> DataFrame:
    """Customers and mean predicted value per churn band and propensity band."""
    churn = F.coalesce(churn_band(F.col("churn_risk_score"), high, medium), F.lit(NO_CHURN_BAND))
    propensity = propensity_band(F.col("purchase_propensity_score"), " Propensity", high, medium)
    grouped = t.customer_scores.groupBy(churn.alias("churn_risk_band"), propensity.alias("propensity_band"))
    bands = grouped.agg(_rows("customer_count"), _mean_prediction())
    return bands.orderBy("churn_risk_band", "propensity_band")


def bands_by_year(t: Tables, high: str = "0.5", medium: str = "0.3") -> DataFrame:
    """Scored customers per sign-up year, churn band and propensity band, with the sum of predicted values: at most
    twelve rows per year, from one join of customers and scores."""
    years = t.customers.select("customer_id", F.year("signup_date").alias("year"))
    churn = churn_band(F.col("churn_risk_score"), high, medium).alias("churn_risk_band")
    propensity = propensity_band(F.col("purchase_propensity_score"), "", high, medium).alias("propensity_band")
    return years.join(t.customer_scores, "customer_id").groupBy("year", churn, propensity).agg(
        _rows("customers"), total(F.col("predicted_ltv")).alias("predicted"), F.count("predicted_ltv").alias("predictions")
    )


def churn_bands(bands: DataFrame) -> DataFrame:
    """Churn bands of customers with a churn score per sign-up year."""
    scored = bands.where(F.col("churn_risk_band").isNotNull()).groupBy("year", "churn_risk_band")
    mean = ratio(F.sum("predicted"), F.sum("predictions")).alias("avg_predicted_ltv")
    return scored.agg(F.sum("customers").alias("customer_count"), mean).orderBy("year", "churn_risk_band")


def propensity_bands(bands: DataFrame) -> DataFrame:
    sums = bands.groupBy("year", "propensity_band").agg(F.sum("customers").alias("customer_count"))
    return sums.orderBy("year", "propensity_band")


def churn_bands_by_year(t: Tables, high: str = "0.5", medium: str = "0.3") -> DataFrame:
    return churn_bands(bands_by_year(t, high, medium))


def propensity_bands_by_year(t: Tables, high: str = "0.5", medium: str = "0.3") -> DataFrame:
    return propensity_bands(bands_by_year(t, high, medium))


def browse_stats(t: Tables) -> DataFrame:
    """Top-of-funnel behaviour per customer.

    The one distinct count runs in two steps on (customer, session), which also spreads a customer with very many
    events.  The mobile share counts events, not sessions, despite its name.
    """
    browsing = t.ga4_events.where(F.col("event_name").isin(*BROWSE_STAGES))
    per_customer = browsing.groupBy("customer_id").agg(
        F.count_if(F.col("event_name") == "page_view").alias("page_views"),
        F.count_if(F.col("event_name") == "view_item").alias("view_item_events"),
        F.count_distinct("session_id").alias("distinct_sessions"),
        F.count_if(F.col("device_category") == "mobile").alias("mobile_events"),
        _rows("browse_events"),
    )
    return per_customer.select(
        "customer_id",
        "page_views",
        "view_item_events",
        "distinct_sessions",
        percent(F.col("mobile_events"), F.col("browse_events"), 1).alias("mobile_session_pct"),
    )


def event_activity(t: Tables) -> DataFrame:
    """Lifetime events and distinct active days per customer."""
    return t.ga4_events.groupBy("customer_id").agg(
        _rows("total_events"), F.count_distinct("event_date").alias("active_days")
    )


def message_engagement(t: Tables) -> DataFrame:
    """Messages sent, opened and clicked per customer."""
    return t.crm_engagement.groupBy("customer_id").agg(
        _rows("total_sent"), as_count(F.col("opened")).alias("total_opened"),
        as_count(F.col("clicked")).alias("total_clicked"),
    )


def engagement_counts(t: Tables) -> DataFrame:
    """Event and message activity of every customer seen in either log."""
    return event_activity(t).join(message_engagement(t), "customer_id", "full_outer")


def target_summary(rows: DataFrame, value: str) -> DataFrame:
    """Count, mean, spread and exact quartiles of a money column, as one row.

    Values are counted first; everything else works on distinct values, so no task holds the whole column.  The spread
    comes from exact sums of whole cents, taken about a whole number next to the mean: values that are all equal have a
    spread of 0, and close ones lose no digits.
    """
    known = rows.where(F.col(value).isNotNull()).select(F.col(value).cast("decimal(18,2)").alias("v"))
    n, v = F.col("n"), F.col("v").cast("double")
    moments = [
        F.sum("n").alias("count"),
        F.sum(F.col("v") * n).cast("decimal(38,2)").cast("double").alias("whole"),
        F.sum((F.col("v") * 100).cast("decimal(18,0)") * n).cast("decimal(38,0)").alias("cents"),
        F.sum(((F.col("v") * 100).cast("decimal(18,0)") * (F.col("v") * 100).cast("decimal(18,0)")).cast("decimal(26,0)") * n.cast("decimal(12,0)")).alias("squares"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    ]
    quartiles = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    line = exact_percentiles(known.groupBy("v").agg(_rows("n")), "v", quartiles, also=moments)
    size = F.col("count").cast("decimal(12,0)")
    middle = F.floor(F.col("cents") / F.col("count")).cast("decimal(16,0)")
    # sums of (value - middle) and of its square
    line = line.withColumn("middle", middle).select(
        "*",
        (F.col("cents") - size * F.col("middle")).cast("double").alias("off"),
        (F.col("squares") - (F.col("middle") * F.col("cents").cast("decimal(20,0)")) * 2 + size * (F.col("middle") * F.col("middle")).cast("decimal(26,0)"))
        .cast("double").alias("apart"),
    )
    spread = (F.col("apart") - F.col("off") * F.col("off") / F.col("count")) / 10_000
    return line.select(
        "count",
        (F.col("whole") / F.col("count")).alias("mean"),
        F.sqrt(spread / F.nullif(F.col("count") - 1, F.lit(0))).alias("std"),
        "min",
        *quartiles,
        "max",
    )


def class_rate(rows: DataFrame, label: str, is_test: str = "is_test") -> DataFrame:
    """Rows and share of positives overall, in the training part and in the held-out part, from one pass."""
    def part(name: str, inside: Column) -> Column:
        counted = F.count_if(inside).alias("n")
        positive = F.count_if(inside & (F.col(label) == 1)).alias("positives")
        return F.struct(F.lit(name).alias("part"), counted, positive)

    parts = {"all": F.lit(True), "train": ~F.col(is_test), "test": F.col(is_test)}
    sums = rows.agg(F.array(*[part(name, inside) for name, inside in parts.items()]).alias("parts"))
    lines = sums.select(F.explode("parts").alias("p")).select("p.part", "p.n", "p.positives")
    return lines.withColumn("positive_pct", percent(F.col("positives"), F.col("n"), 1))
