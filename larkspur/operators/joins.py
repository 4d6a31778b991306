"""Customer joins.

Orders are summed per customer before they meet the customer table: a customer with a third of all orders then
weighs one row, and "distinct buyers" is a plain count.  Only ``completed_orders_with_country`` must keep every order.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.money import total
from larkspur.operators.scale import skew_safe_join, spark_splits_skew
from larkspur.sources.tables import Tables


def completed_orders(t: Tables) -> DataFrame:
    return t.orders.where((F.col("order_status") == "completed") & F.col("customer_id").isNotNull())


def buyer_spend(t: Tables) -> DataFrame:
    """One row per customer with a completed order: ``customer_id``, ``total_spend``."""
    return completed_orders(t).groupBy("customer_id").agg(total(F.col("total_amount")).alias("total_spend"))


def buyers(t: Tables) -> DataFrame:
    return completed_orders(t).select("customer_id").distinct()


def completed_orders_with_country(t: Tables) -> DataFrame:
    orders = completed_orders(t).select("order_id", "customer_id", "order_date", "total_amount")
    countries = t.customers.select("customer_id", "country")
    if spark_splits_skew(orders.sparkSession):
        # One row per customer on the other side and nothing after the join: Spark may split a hot customer's orders by
        # their written sizes, so no pass over the orders has to find them first.
        joined = orders.join(countries, "customer_id")
    else:
        joined = skew_safe_join(orders, countries, ["customer_id"], spread=["order_id"])
    return joined.select("customer_id", "country", "order_date", "total_amount")


def revenue_by_country(t: Tables) -> DataFrame:
    spend = t.customers.select("customer_id", "country").join(buyer_spend(t), "customer_id")
    return (
        spend.groupBy("country")
        .agg(F.count(F.lit(1)).alias("distinct_customers"), total(F.col("total_spend")).alias("total_revenue"))
        .select("distinct_customers", "country", "total_revenue")
        .orderBy(F.col("total_revenue").desc_nulls_first(), "country")
    )


def total_spend_all_customers(t: Tables) -> DataFrame:
    """Every customer; spend is NULL, not 0, for those who never completed an order."""
    return t.customers.select("customer_id", "country").join(buyer_spend(t), "customer_id", "left")


def country_buyers_semi(t: Tables, country: str) -> DataFrame:
    """Customers of one country with a completed order."""
    there = t.customers.where(F.col("country") == country).select("customer_id", "country")
    return there.join(buyers(t), "customer_id", "left_semi")


def country_buyers_cte(t: Tables, country: str) -> DataFrame:
    """The same list, written as SQL with a named sub-query and a bound parameter."""
    return t.customers.sparkSession.sql(
        """
        WITH has_bought AS (SELECT DISTINCT customer_id FROM {orders} WHERE order_status = 'completed')
        SELECT person.customer_id, person.country
        FROM {customers} AS person LEFT SEMI JOIN has_bought ON person.customer_id = has_bought.customer_id
        WHERE person.country = :country
        """,
        args={"country": country},
        orders=t.orders,
        customers=t.customers,
    )


def avg_buyer_spend_by_channel(t: Tables) -> DataFrame:
    """Average spend per buyer, by the channel that brought the buyer."""
    spend = t.customers.select("customer_id", "acquisition_channel").join(buyer_spend(t), "customer_id")
    average = F.avg(F.col("total_spend").cast("decimal(22,2)"))
    return spend.groupBy("acquisition_channel").agg(average.alias("avg_spend_per_customer")).orderBy(
        F.desc("avg_spend_per_customer")
    )


def combine_scores(churn: DataFrame, propensity: DataFrame, ltv: DataFrame, scored_at: datetime) -> DataFrame:
    """One row per customer found in any of the three score sets, stamped with the time of the run."""
    merged = propensity.join(ltv, "customer_id", "full_outer").join(churn, "customer_id", "full_outer")
    return merged.select(
        "customer_id",
        "churn_risk_score",
        "purchase_propensity_score",
        "predicted_ltv",
        F.lit(scored_at).cast("timestamp").alias("scored_at"),
    )
