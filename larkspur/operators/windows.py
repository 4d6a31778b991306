"""Rank, running total and funnel windows, shaped so that no task sorts a whole channel or country."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.money import percent, total
from larkspur.operators.aggregates import funnel_all_time
from larkspur.operators.joins import buyer_spend
from larkspur.operators.scale import attach_small, keep, positions, skew_safe_join
from larkspur.sources.tables import Tables


def spend_rank_in_country(t: Tables) -> DataFrame:
    """Rank of every buyer by spend within the country, ties sharing a rank.

    A rank is one plus the number of buyers who spent more, worked out once per distinct (country, spend) from counts
    and then joined back to the buyers, so no task sorts the buyers of a country.
    """
    columns = ["customer_id", "country", "total_spend", "spend_rank"]
    spend = t.customers.select("customer_id", "country").join(buyer_spend(t), "customer_id")
    spend = keep(spend, "buyer-spend")
    counts = spend.groupBy("country", "total_spend").agg(F.count(F.lit(1)).alias("n"))
    placed = positions(counts, "total_spend", group=["country"], descending=True)
    ranks = placed.select("country", "total_spend", (F.col("before") + 1).alias("spend_rank"))
    return skew_safe_join(spend, ranks, ["country", "total_spend"], spread=["customer_id"]).select(columns)


def running_channel_cost(t: Tables) -> DataFrame:
    """Every spend row with its channel's cost to date; rows of one day share the total of that day.

    The window runs over one row per channel and day, and its result is attached to the rows without moving them.
    """
    daily = t.marketing_spend.groupBy("channel", "spend_date").agg(total(F.col("cost")).alias("day_cost"))
    to_date = Window.partitionBy("channel").orderBy("spend_date")
    running = daily.select(
        "channel", "spend_date", F.sum("day_cost").over(to_date).cast("decimal(38,2)").alias("running_total_cost")
    )
    rows = t.marketing_spend.select("spend_date", "channel", "cost")
    attached = attach_small(rows, running, ["channel", "spend_date"], how="left", label="running-cost")
    return attached.select("spend_date", "channel", "cost", "running_total_cost")


def _funnel_window():
    # Unpartitioned, over one row per event name.
    return Window.orderBy(F.col("stage_order").asc_nulls_last(), "event_name")


def funnel_stage_lag(t: Tables) -> DataFrame:
    """Each stage with the count of the stage before it."""
    before = F.lag("event_count").over(_funnel_window())
    stages = funnel_all_time(t).withColumn("previous_stage_count", before)
    share = percent(F.col("event_count"), F.col("previous_stage_count"), 1)
    return stages.withColumn("pct_of_previous_stage", share).orderBy(
        F.col("stage_order").asc_nulls_last(), "event_name"
    ).select("event_name", "event_count", "previous_stage_count", "pct_of_previous_stage")


def funnel_conversion(t: Tables) -> DataFrame:
    return stage_shares(funnel_all_time(t))


def stage_shares(funnel: DataFrame) -> DataFrame:
    """Each stage as a share of the first stage and of the stage before it."""
    w = _funnel_window()
    stages = funnel.select(
        "*", F.first("event_count").over(w).alias("top"), F.lag("event_count").over(w).alias("previous")
    )
    return stages.orderBy(F.col("stage_order").asc_nulls_last(), "event_name").select(
        "event_name",
        "event_count",
        percent(F.col("event_count"), F.col("top"), 1).alias("pct_of_total"),
        percent(F.col("event_count"), F.col("previous"), 1).alias("pct_of_previous_stage"),
    )
