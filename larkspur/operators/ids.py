"""Surrogate keys and repeatable pseudo-random assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_prefix(key: Column, digits: int = 4) -> Column:
    """First hex digits of the key's MD5: evenly spread, the same on every engine and in every run."""
    return F.substring(F.md5(key.cast("string")), 1, digits)


def assign_ids(rows: DataFrame, key: str, name: str = "id", digits: int = 4, start: int = 1) -> DataFrame:
    """Number the rows ``start``, ``start + 1``, ... without gaps and without one global sort.

    ``key`` must be unique.  Rows fall into ``16 ** digits`` hash buckets of about equal size; a running sum over the
    bucket counts (a table whose size is fixed by ``digits``) gives each bucket its first number.  Everything follows
    from the key, so recomputing a lost task gives the same numbers.
    """
    bucketed = rows.withColumn("_bucket", hash_prefix(F.col(key), digits))
    ahead = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        bucketed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_first"))
    )
    inside = Window.partitionBy("_bucket").orderBy(key)
    numbered = bucketed.withColumn("_row", F.row_number().over(inside))
    placed = numbered.join(F.broadcast(starts), "_bucket")  # at most 16 ** digits rows
    return placed.withColumn(name, F.col("_first") + F.col("_row") + F.lit(start - 1)).drop("_bucket", "_first", "_row")


def is_held_out(key: Column, seed: int = 42, share: float = 0.2) -> Column:
    """True for about ``share`` of the keys: a hash cut that needs no shuffle and never changes for a key."""
    cut = f"{int(share * 65536):04x}"
    return hash_prefix(F.concat(key.cast("string"), F.lit(f"-{seed}"))) < cut


def hold_out(rows: DataFrame, key: str, seed: int = 42, share: float = 0.2) -> DataFrame:
    """Add ``is_test`` for about ``share`` of the keys.

    The cut depends on the key only, so every target built on the same keys is split alike.
    """
    return rows.withColumn("is_test", is_held_out(F.col(key), seed, share))


def stratified_hold_out(
    rows: DataFrame, key: str, label: str, seed: int = 42, share: float = 0.2, digits: int = 4
) -> DataFrame:
    """Add ``is_test`` for ``round(share x keys)`` keys of each class, the ones with the smallest hashes.

    A key with several rows belongs to the class of its highest label and lies on one side with all of them.  The border
    of a class is found from counts per hash prefix, at most ``16 ** digits`` per class; keys are ordered one by one
    only within a prefix.
    """
    code = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")))
    keys = rows.groupBy(key).agg(F.max(label).alias("_class"))
    keys = keys.withColumn("_code", code).withColumn("_bucket", F.substring("_code", 1, digits))
    counts = keys.groupBy("_class", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy("_class").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    take = F.round(F.sum("_n").over(Window.partitionBy("_class")) * F.lit(share).cast("decimal(6,4)"), 0)
    taken = counts.select(
        "_class", "_bucket", (take - F.coalesce(F.sum("_n").over(ahead), F.lit(0))).cast("bigint").alias("_left")
    )
    inside = Window.partitionBy("_class", "_bucket").orderBy("_code", key)
    placed = keys.withColumn("_place", F.row_number().over(inside)).join(taken, ["_class", "_bucket"])
    marks = placed.select(key, (F.col("_place") <= F.col("_left")).alias("is_test"))
    return rows.join(marks, key)


def assign_variants(population: DataFrame, experiment: str, seed: int = 42) -> DataFrame:
    """Put each customer in variant A or B, evenly and repeatably per experiment."""
    draw = hash_prefix(F.concat(F.col("customer_id").cast("string"), F.lit(f"-{experiment}-{seed}")))
    variant = F.when(draw < "8000", "A").otherwise("B")
    return population.select("customer_id", F.lit(experiment).alias("experiment_name"), variant.alias("variant"))
