"""Data-quality checks.  Each returns rows of (check, bad_rows, total_rows); ``report`` stacks them."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.labels import channel_clean
from larkspur.functions.money import as_count
from larkspur.operators.aggregates import funnel_all_time
from larkspur.operators.windows import _funnel_window
from larkspur.sources.tables import Tables


def _line(rows: DataFrame, check: str, bad: Column) -> DataFrame:
    return _lines(rows, {check: bad})


def _lines(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """All row-level checks of one table in one pass over it."""
    whole = F.count(F.lit(1)).alias("total_rows")
    parts = [F.struct(F.lit(name).alias("check"), as_count(bad).alias("bad_rows"), whole) for name, bad in checks.items()]
    lines = rows.agg(F.array(*parts).alias("parts")).select(F.explode("parts").alias("p"))
    return lines.select("p.check", "p.bad_rows", "p.total_rows")


def _summed(counted: DataFrame, check: str, bad: Column, weight: str = "n") -> DataFrame:
    """A check over pre-counted groups: sum of the bad counts and of all counts."""
    zero = F.lit(0)
    return counted.agg(
        F.coalesce(F.sum(bad), zero).cast("bigint").alias("bad_rows"),
        F.coalesce(F.sum(weight), zero).cast("bigint").alias("total_rows"),
    ).select(F.lit(check).alias("check"), "bad_rows", "total_rows")


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def primary_key(rows: DataFrame, table: str, key: str) -> DataFrame:
    """Bad: rows without a key, and every row of a key after its first."""
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    bad = F.when(F.col(key).isNull(), F.col("n")).otherwise(F.col("n") - 1)
    return _summed(per_key, f"primary_key:{table}.{key}", bad)


def foreign_key(rows: DataFrame, parents: DataFrame, table: str, key: str = "customer_id") -> DataFrame:
    """Bad: rows whose non-NULL key has no parent.  Rows are counted per key before the anti join."""
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = parents.select(F.col(key).alias("_parent")).distinct()
    matched = per_key.join(known, per_key[key] == known["_parent"], "left")
    bad = F.when(F.col(key).isNotNull() & F.col("_parent").isNull(), F.col("n"))
    return _summed(matched, f"foreign_key:{table}.{key}", bad)


def not_null(rows: DataFrame, table: str, columns: list[str]) -> DataFrame:
    return _lines(rows, {f"not_null:{table}.{c}": F.col(c).isNull() for c in columns})


def domain(rows: DataFrame, table: str, allowed: dict[str, tuple]) -> DataFrame:
    """Bad: values outside the vocabulary; NULL is a matter for ``not_null``."""
    return _lines(rows, {f"domain:{table}.{c}": F.coalesce(~F.col(c).isin(*v), F.lit(False)) for c, v in allowed.items()})


def funnel_shape(t: Tables) -> DataFrame:
    """Bad: known stages that count at least as many events as the stage before them."""
    stages = funnel_all_time(t).where(F.col("stage_order").isNotNull())
    rising = F.col("event_count") >= F.lag("event_count").over(_funnel_window())
    return _line(stages.select(rising.alias("rising")), "funnel_shape", F.coalesce("rising", F.lit(False)))


def click_implies_open(t: Tables) -> DataFrame:
    bad = F.col("clicked") & ~F.coalesce("opened", F.lit(False))
    return _line(t.crm_engagement, "click_implies_open", bad)


def order_total(orders: DataFrame) -> DataFrame:
    """Bad: total amount other than unit price times quantity."""
    return _line(orders, "order_total", F.col("total_amount") != F.col("unit_price") * F.col("quantity"))


def orders_vs_purchases(t: Tables) -> DataFrame:
    """Bad: (customer, date) pairs whose orders and purchase events differ in number."""
    purchases = t.ga4_events.where((F.col("event_name") == "purchase") & F.col("customer_id").isNotNull())
    clicks = purchases.groupBy("customer_id", F.col("event_date").alias("day")).agg(F.count(F.lit(1)).alias("clicks"))
    placed = t.orders.where(F.col("customer_id").isNotNull()).groupBy("customer_id", F.col("order_date").alias("day"))
    both = placed.agg(F.count(F.lit(1)).alias("orders")).join(clicks, ["customer_id", "day"], "full_outer")
    return _line(both, "orders_vs_purchases", ~F.col("orders").eqNullSafe(F.col("clicks")))


def end_date_status(t: Tables, as_of: date) -> DataFrame:
    """Bad: an end date on an active subscription, none on another, or one in the future."""
    active = F.coalesce(F.col("status") == "active", F.lit(False))
    late = F.coalesce(F.col("end_date") > F.lit(as_of), F.lit(False))
    return _line(t.subscriptions, "end_date_status", (F.col("end_date").isNull() != active) | late)


def spend_grid(t: Tables) -> DataFrame:
    """Bad: cells of the grid of all dates by all (channel, campaign) pairs that have more than one row, or none.

    The grid is counted, not built: its size is the product of two counts, and the cells that have rows are grouped.
    """
    cells = t.marketing_spend.groupBy("spend_date", "channel", "campaign_name").agg(F.count(F.lit(1)).alias("n"))
    pair = F.struct("channel", "campaign_name")
    sums = cells.agg(
        F.count_distinct(F.struct("spend_date")).alias("dates"),
        F.count_distinct(pair).alias("pairs"),
        F.count(F.lit(1)).alias("filled"),
        as_count(F.col("n") != 1).alias("doubled"),
    )
    grid = F.col("dates") * F.col("pairs")
    bad = F.col("doubled") + grid - F.col("filled")
    return sums.select(F.lit("spend_grid").alias("check"), bad.alias("bad_rows"), grid.alias("total_rows"))


def channel_mapping(t: Tables) -> DataFrame:
    """Bad: spend rows of platforms without an acquisition channel."""
    return _line(t.marketing_spend, "channel_mapping", channel_clean(F.col("channel")).isNull())


def source_matches_channel(events: DataFrame, customers: DataFrame) -> DataFrame:
    """Bad: events whose traffic source is not the lower-cased channel of their customer, those without a known customer
    included.  Events are counted per (customer, source) before they meet the customers."""
    counted = events.groupBy("customer_id", "traffic_source").agg(F.count(F.lit(1)).alias("n"))
    known = customers.select("customer_id", "acquisition_channel", F.lit(True).alias("known"))
    joined = counted.join(known, "customer_id", "left")
    same = F.col("known") & F.col("traffic_source").eqNullSafe(F.lower("acquisition_channel"))
    differs = ~F.coalesce(same, F.lit(False))
    return _summed(joined, "source_matches_channel", F.when(differs, F.col("n")))


def variant_balance(t: Tables) -> DataFrame:
    """Bad, per experiment: rows that would have to change sides for an even split of variants A and B, where that is
    beyond chance.  The total counts all rows of the experiment, other variants included."""
    counts = t.ab_test_assignments.groupBy("experiment_name").agg(
        F.count_if(F.col("variant") == "A").alias("a"),
        F.count_if(F.col("variant") == "B").alias("b"),
        F.count(F.lit(1)).alias("total_rows"),
    )
    # Bad: the rows that would have to change sides for an even split, beyond three standard deviations of chance.
    excess = F.abs(F.col("a") - F.col("b")) / 2
    tolerated = 1.5 * F.sqrt(F.col("total_rows").cast("double"))
    bad = F.when(excess > tolerated, F.floor(excess)).otherwise(0).cast("bigint")
    return counts.select(
        F.concat(F.lit("variant_balance:"), "experiment_name").alias("check"), bad.alias("bad_rows"), "total_rows"
    )
