"""Acquisition cost, return on ad spend, retention, customer value, channel performance."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.dates import month_name, months_until, shift_period, year_month
from larkspur.functions.labels import PAID_CHANNELS, channel_clean
from larkspur.functions.money import percent, ratio, total
from larkspur.operators.filters import activity_periods
from larkspur.operators.joins import buyer_spend
from larkspur.sources.tables import Tables


def channel_names(t: Tables) -> DataFrame:
    """Each ad platform in use, the acquisition channel it maps to, and its rows."""
    per_platform = t.marketing_spend.groupBy("channel").agg(F.count(F.lit(1)).alias("spend_rows"))
    return per_platform.select("channel", channel_clean(F.col("channel")).alias("channel_clean"), "spend_rows")


def spend_by_channel(t: Tables, *keys: Column) -> DataFrame:
    """Ad spend per acquisition channel; platforms without one are added up under NULL."""
    grouped = t.marketing_spend.groupBy(*keys, channel_clean(F.col("channel")).alias("channel_clean"))
    return grouped.agg(total(F.col("cost")).alias("total_spend"))


def _paid(t: Tables) -> DataFrame:
    return t.customers.where(F.col("acquisition_channel").isin(*PAID_CHANNELS))


def cac_by_channel(t: Tables) -> DataFrame:
    """Spend divided by customers won, per paid channel."""
    won = _paid(t).groupBy(F.col("acquisition_channel").alias("channel_clean")).agg(
        F.count(F.lit(1)).alias("new_customers")
    )
    both = spend_by_channel(t).join(won, "channel_clean")
    return both.withColumn("cac", ratio(F.col("total_spend"), F.col("new_customers"))).orderBy("cac", "channel_clean")


def roas_by_channel(t: Tables) -> DataFrame:
    """Completed revenue of the channel's customers divided by its spend."""
    earned = _paid(t).select("customer_id", F.col("acquisition_channel").alias("channel_clean")).join(
        buyer_spend(t), "customer_id"
    )
    revenue = earned.groupBy("channel_clean").agg(total(F.col("total_spend")).alias("total_revenue"))
    both = spend_by_channel(t).join(revenue, "channel_clean")
    return both.withColumn("roas", ratio(F.col("total_revenue"), F.col("total_spend"))).orderBy(
        F.desc("roas"), "channel_clean"
    )


# --- retention -------------------------------------------------------------------------------------------------


def retention(rows: DataFrame, day: str, grain: str = "month", label: str = "activity_month") -> DataFrame:
    """Customers active in a period, how many of them were active in the next one, and the share.

    A customer's distinct periods are put in order, and each looks at the one after it: no self-join.  The distinct
    step spreads a very active customer over (customer, period) and leaves the window at most one row per period and
    customer.  Rows without a customer keep their period in the report but count nobody.
    """
    seen = activity_periods(rows, day, grain, label)
    after = F.lead(label).over(Window.partitionBy("customer_id").orderBy(label))
    known = F.col("customer_id").isNotNull()
    back = F.coalesce(after == shift_period(F.col(label), grain, 1), F.lit(False))
    counts = seen.select("customer_id", label, (known & back).alias("back")).groupBy(label).agg(
        F.count("customer_id").alias("active_customers"), F.count_if(F.col("back")).alias("retained_next_month")
    )
    rate = percent(F.col("retained_next_month"), F.col("active_customers"), 1)
    return counts.withColumn("retention_rate_pct", rate).orderBy(label)


def retention_selfjoin(rows: DataFrame, day: str, grain: str = "month", label: str = "activity_month") -> DataFrame:
    """The same report by matching each (customer, period) with the next period: kept as a cross-check."""
    seen = activity_periods(rows, day, grain, "period")
    following = seen.select(
        F.col("customer_id").alias("same_customer"), shift_period(F.col("period"), grain, -1).alias("previous")
    )
    match = (seen["customer_id"] == following["same_customer"]) & (seen["period"] == following["previous"])
    counts = (
        seen.join(following, match, "left")
        .groupBy(F.col("period").alias(label))
        .agg(
            F.count("customer_id").alias("active_customers"),
            F.count("same_customer").alias("retained_next_month"),
        )
    )
    rate = percent(F.col("retained_next_month"), F.col("active_customers"), 1)
    return counts.withColumn("retention_rate_pct", rate).orderBy(label)


def retention_monthly(t: Tables) -> DataFrame:
    return retention(t.ga4_events, "event_date")


def retention_curve(rows: DataFrame, day: str) -> DataFrame:
    """Monthly retention with a ``yyyy-MM`` label."""
    months = retention(rows, day)
    return months.withColumn("activity_month", year_month(F.col("activity_month")))


def retention_by_year(rows: DataFrame, day: str) -> DataFrame:
    """Monthly retention with year, month name and month number."""
    month = F.col("activity_month")
    return retention(rows, day).select(
        F.year(month).alias("year"),
        month_name(month).alias("month"),
        F.month(month).alias("month_num"),
        "active_customers",
        "retained_next_month",
        "retention_rate_pct",
    )


# --- customer value --------------------------------------------------------------------------------------------


def subscription_value(t: Tables, as_of: date) -> DataFrame:
    """Subscription revenue per customer: monthly price times months run, at least one, for every subscription."""
    months = F.greatest(months_until(F.col("start_date"), F.col("end_date"), as_of), F.lit(1))
    paid = t.subscriptions.where(F.col("customer_id").isNotNull())
    return paid.groupBy("customer_id").agg(total(F.col("mrr") * months).alias("subscribed"))


def with_value(people: DataFrame, t: Tables, as_of: date) -> DataFrame:
    """``people`` (one row per customer) with order revenue ``bought`` and subscription revenue ``subscribed``, NULL
    where there is none, and their sum ``total_ltv``.

    Both revenues are summed per customer first, so the joins meet one row per customer on each side, all spread by
    the same key.
    """
    joined = people.join(buyer_spend(t).withColumnRenamed("total_spend", "bought"), "customer_id", "left").join(
        subscription_value(t, as_of), "customer_id", "left"
    )
    zero = F.lit(0).cast("decimal(38,2)")
    value = F.coalesce("bought", zero).cast("decimal(20,2)") + F.coalesce("subscribed", zero).cast("decimal(20,2)")
    return joined.withColumn("total_ltv", value)


def customer_value(t: Tables, as_of: date, only: tuple[str, ...] | None = None) -> DataFrame:
    """Value of every customer, or of those of some acquisition channels."""
    people = t.customers if only is None else t.customers.where(F.col("acquisition_channel").isin(*only))
    return with_value(people.select("customer_id", "acquisition_channel", "signup_date"), t, as_of)


def customer_ltv(t: Tables, as_of: date) -> DataFrame:
    zero = F.lit(0).cast("decimal(38,2)")
    return customer_value(t, as_of).select(
        "customer_id",
        "acquisition_channel",
        F.coalesce("bought", zero).alias("ecommerce_ltv"),
        F.coalesce("subscribed", zero).alias("saas_ltv"),
        "total_ltv",
    )


def top_ltv_customers(t: Tables, as_of: date, n: int = 20) -> DataFrame:
    return customer_ltv(t, as_of).orderBy(F.desc("total_ltv"), "customer_id").limit(n)


def cohort_value(t: Tables, as_of: date) -> DataFrame:
    """Customers won, their value and their order revenue per sign-up year and paid channel, from one pass over
    customers, orders and subscriptions: at most two rows per year."""
    keys = [F.year("signup_date").alias("year"), F.col("acquisition_channel").alias("channel")]
    return customer_value(t, as_of, PAID_CHANNELS).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("new_customers"),
        total(F.col("total_ltv")).alias("value"),
        total(F.col("bought")).alias("total_revenue"),
    )


def yearly_spend(t: Tables) -> DataFrame:
    return spend_by_channel(t, F.year("spend_date").alias("year")).withColumnRenamed("channel_clean", "channel")


def _all_years(cohorts: DataFrame) -> DataFrame:
    return cohorts.groupBy("channel").agg(
        F.sum("new_customers").alias("new_customers"),
        total(F.col("value")).alias("value"),
        total(F.col("total_revenue")).alias("total_revenue"),
    )


def _spend_all_years(spend: DataFrame) -> DataFrame:
    return spend.groupBy("channel").agg(total(F.col("total_spend")).alias("total_spend"))


def ltv_to_cac(t: Tables, as_of: date) -> DataFrame:
    """Average value over acquisition cost, the cost being rounded to cents first."""
    both = _all_years(cohort_value(t, as_of)).join(_spend_all_years(yearly_spend(t)), "channel")
    cac = ratio(F.col("total_spend"), F.col("new_customers"))
    return both.withColumn("cac", cac).select(
        F.col("channel").alias("acquisition_channel"),
        ratio(F.col("value"), F.col("new_customers")).alias("avg_ltv"),
        "cac",
        ratio(F.col("value"), F.col("cac") * F.col("new_customers")).alias("ltv_to_cac_ratio"),
    ).orderBy(F.desc("ltv_to_cac_ratio"), "acquisition_channel")


def _performance(both: DataFrame, *keys: str) -> DataFrame:
    # Average value over unrounded cost per customer: both divide by the same customers, which cancel out.
    return both.select(
        *keys,
        "channel",
        "total_spend",
        "new_customers",
        ratio(F.col("total_spend"), F.col("new_customers")).alias("cac"),
        "total_revenue",
        ratio(F.col("total_revenue"), F.col("total_spend")).alias("roas"),
        ratio(F.col("value"), F.col("new_customers")).alias("avg_ltv"),
        ratio(F.col("value"), F.col("total_spend")).alias("ltv_to_cac_ratio"),
    )


def performance_all_time(cohorts: DataFrame, spend: DataFrame) -> DataFrame:
    """Per channel, from ``cohort_value`` and ``yearly_spend``.  A channel without spend or revenue is left out."""
    earning = _all_years(cohorts).where(F.col("total_revenue").isNotNull())
    return _performance(_spend_all_years(spend).join(earning, "channel")).orderBy("channel")


def performance_by_year(cohorts: DataFrame, spend: DataFrame) -> DataFrame:
    """Per sign-up year and channel.  A cohort without spend or revenue keeps its row."""
    both = cohorts.join(spend, ["year", "channel"], "left")
    return _performance(both, "year").orderBy("year", "channel")


def channel_performance(t: Tables, as_of: date) -> DataFrame:
    """Spend, customers, cost, revenue, return and value per paid channel."""
    return performance_all_time(cohort_value(t, as_of), yearly_spend(t))


def channel_performance_by_year(t: Tables, as_of: date) -> DataFrame:
    """The same per sign-up year: spend of that year, value and revenue to date of the customers won in it."""
    return performance_by_year(cohort_value(t, as_of), yearly_spend(t))


def cohort_left_joins(t: Tables) -> DataFrame:
    """Customers won per year and paid channel next to the spend of that year, kept when nothing was spent."""
    won = _paid(t).groupBy(F.year("signup_date").alias("year"), F.col("acquisition_channel").alias("channel")).agg(
        F.count(F.lit(1)).alias("new_customers")
    )
    return won.join(yearly_spend(t), ["year", "channel"], "left").orderBy("year", "channel")
