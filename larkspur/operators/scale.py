"""Helpers that keep plans whole when one key holds a large share of the rows.

* ``keep``            cuts lineage by writing a table into the cluster's shared folder; the files' size is then known.
* ``skew_safe_join``  joins many rows to one row per key, spreading the rows of hot keys over several tasks.
* ``dealt``           spreads rows that are small but costly, such as rows a forest scores, over all tasks.
* ``attach_small``    joins a small side by broadcast only after counting it, and by a skew-safe join otherwise.
* ``positions``       cumulative counts over ordered values without ever sorting one big group in one task.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000  # at most this many narrow rows go to every executor
TASK_ROWS = 5_000_000  # rows one reduce task should meet for one key; a key with more is hot and gets several tasks
MOST_PARTS = 4**8  # parts of the hottest key


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="larkspur-")


def work_folder(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the one ``spark.checkpoint.dir`` names.

    Only a local master may fall back to a temporary folder; other executors could not read it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


def keep(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written once as a Parquet table in the shared folder and read back.

    A lost executor costs a re-read instead of a recomputation, and Spark knows the true size of what it joins next.
    """
    spark = rows.sparkSession
    path = f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def in_parallel(actions: list[Callable[[], object]], at_once: int = 8) -> list:
    """Run independent jobs side by side, so that the tail of one does not leave the cluster idle."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(lambda action: action(), actions))


def keep_all(frames: Mapping[str, DataFrame]) -> list[DataFrame]:
    """``keep`` for several independent tables at once, in the given order."""
    return in_parallel([lambda label=label, rows=rows: keep(rows, label) for label, rows in frames.items()])


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` dealt evenly over all tasks of a shuffle, before a step whose work follows from the rows and not their bytes.

    Spark sizes tasks by bytes: a few megabytes, and so a few tasks, may hold all rows that a large model has to score.
    """
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism))


def hot_parts(
    rows: DataFrame, keys: list[str], task_rows: int = TASK_ROWS, tracked: int = 50_000
) -> dict[int, list[int]]:
    """Keys with more than ``task_rows`` rows, as hashes, grouped by the number of parts each should be split into.

    One pass with a frequent-items sketch, merged in lanes and then once more: no shuffle of keys, and the size of a
    sketch is fixed by ``tracked``.  Its counts are off by less than one row in 14,000.  They only steer where rows go:
    a key the sketch misses is slower, never wrong.
    """
    one = rows.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("code"))  # a sketch even of no rows
    found = (
        rows.select(F.xxhash64(*keys).alias("code"))
        .union(one)
        .groupBy((F.spark_partition_id() % 256).alias("lane"))
        .agg(F.expr(f"approx_top_k_accumulate(code, {tracked})").alias("sketch"))
        .repartition(1)  # at most 256 sketches; combining fails in a task that got none
        .agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), 10000)").alias("top"))
        .first()
    )
    tiers: dict[int, list[int]] = {}
    for item in found["top"] or []:
        parts = 1
        while parts * task_rows < item["count"] and parts < MOST_PARTS:
            parts *= 4
        if parts > 1:
            tiers.setdefault(parts, []).append(item["item"])
    return tiers


def _parts(keys: list[str], tiers: dict[int, list[int]]) -> Column:
    code, choice = F.xxhash64(*keys), None
    for parts, codes in tiers.items():
        choice = F.when(code.isin(codes), parts) if choice is None else choice.when(code.isin(codes), parts)
    return choice.otherwise(1)


def skew_safe_join(
    rows: DataFrame,
    per_key: DataFrame,
    keys: list[str],
    how: str = "inner",
    spread: list[str] | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Join ``rows`` (any number per key) to ``per_key`` (one row per key) on ``keys``; NULL keys match as equal.

    Rows of a hot key are split into parts by a hash of the ``spread`` columns (all columns when not given), and the
    one matching row of ``per_key`` is repeated once per part.  Other keys are one part.  The part is a function of the
    row alone, so a recomputed task sends each row to the same place.
    """
    tiers = hot_parts(rows, keys, task_rows)
    if not tiers:
        return _join_null_safe(rows, per_key, list(keys), how)
    parts = _parts(keys, tiers)
    part = F.pmod(F.xxhash64(*(spread or rows.columns)), parts).cast("int")
    left = rows.withColumn("_part", part)
    right = per_key.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return _join_null_safe(left, right, [*keys, "_part"], how).drop("_part")


def spark_splits_skew(spark: SparkSession) -> bool:
    """Whether Spark itself deals the rows of a hot key to several tasks, by what a join's shuffle has written."""
    return all(spark.conf.get(f"spark.sql.adaptive.{c}", "true") == "true" for c in ("enabled", "skewJoin.enabled"))


def _join_null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    other = right.select(*[F.col(c).alias(f"_right_{c}") if c in on else F.col(c) for c in right.columns])
    match = None
    for c in on:
        test = left[c].eqNullSafe(other[f"_right_{c}"])
        match = test if match is None else match & test
    return left.join(other, match, how).drop(*[f"_right_{c}" for c in on])


def attach_small(
    rows: DataFrame,
    per_key: DataFrame,
    keys: list[str],
    how: str = "inner",
    label: str = "small",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join a side that is expected to be small: kept, counted, then broadcast if it is, else split by key."""
    kept = keep(per_key, label)
    if kept.limit(max_rows + 1).count() <= max_rows:
        return _join_null_safe(rows, F.broadcast(kept), keys, how)
    return skew_safe_join(rows, kept, keys, how)


def leading_digits(value: Column, digits: int = 3) -> Column:
    """Order-preserving coarse bucket of a money value: its cents with all but the first ``digits`` digits zeroed."""
    cents = (value * 100).cast("bigint")
    surplus = F.greatest(F.length(F.abs(cents).cast("string")) - digits, F.lit(0))
    unit = F.pow(F.lit(10.0), surplus).cast("bigint")
    return cents - cents % unit


def positions(
    counted: DataFrame, value: str, n: str = "n", group: list[str] | None = None, descending: bool = False
) -> DataFrame:
    """Add ``before`` (rows that sort ahead of this value) and ``total`` (rows of the group) to value counts.

    ``counted`` has one row per (group, value) with its row count ``n``.  Counts are first summed over coarse buckets
    (at most 900 per power of ten, whatever the data), the running sum over buckets gives each bucket its start, and
    only values inside one bucket are sorted together.  No window sees a whole group of rows.
    """
    group = list(group or [])
    coarse = counted.withColumn("_bucket", leading_digits(F.col(value)))
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    sums = coarse.groupBy(*group, "_bucket").agg(F.sum(n).alias("_n"))
    over_group = Window.partitionBy(*group)
    ahead = over_group.orderBy(direction("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *group,
        "_bucket",
        F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"),
        F.sum("_n").over(over_group).alias("total"),
    )
    inside = Window.partitionBy(*group, "_bucket").orderBy(direction(value)).rowsBetween(Window.unboundedPreceding, -1)
    placed = _join_null_safe(coarse, starts, [*group, "_bucket"], "inner")
    return placed.withColumn("before", F.col("_start") + F.coalesce(F.sum(n).over(inside), F.lit(0))).drop(
        "_bucket", "_start"
    )


def exact_percentiles(
    counted: DataFrame, value: str, probs: dict[str, float], n: str = "n", also: list[Column] | None = None
) -> DataFrame:
    """One row with exact, linearly interpolated percentiles of the counted values, one column per name in ``probs``.

    ``also`` adds further aggregates of the counted values to the row.
    """
    placed = positions(counted, value, n)
    last, also = F.col("total") - 1, list(also or [])
    picks = []
    for name, p in probs.items():
        for side, wanted in (("lo", F.floor(last * F.lit(p))), ("hi", F.ceil(last * F.lit(p)))):
            holds = (F.col("before") <= wanted) & (wanted < F.col("before") + F.col(n))
            picks.append(F.max(F.when(holds, F.col(value).cast("double"))).alias(f"{name}_{side}"))
    spots = placed.agg(*also, F.max("total").alias("total"), *picks)

    def between(name: str, p: float) -> Column:
        low, high, spot = F.col(f"{name}_lo"), F.col(f"{name}_hi"), last * F.lit(p)
        return (low + (high - low) * (spot - F.floor(spot))).alias(name)

    kept = [c for c in spots.columns if c != "total" and not c.endswith(("_lo", "_hi"))]
    return spots.select(*kept, *[between(name, p) for name, p in probs.items()])
