"""Exhaustive search for the best split of rows by one feature, and stumps built on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _gini(n: Column, first: Column, _: Column) -> Column:
    share = first / n
    return 1 - share * share - (1 - share) * (1 - share)


def _variance(n: Column, first: Column, second: Column) -> Column:
    return second / n - (first / n) * (first / n)


def split_gains(rows: DataFrame, features: list[str], label: str, kind: str = "gini", weight: str | None = None) -> DataFrame:
    """``(feature, threshold, gain, left_mean, right_mean, n_left, n_right)`` of every split between neighbouring values.

    ``kind`` is ``gini`` for a 0/1 label or ``variance`` for a number.  Rows are summed per feature and value before anything is
    ordered: the running sums of a feature see one row per distinct value.  Thresholds lie half way between values; rows
    whose value is null take no part in that feature's splits.
    """
    impurity = {"gini": _gini, "variance": _variance}[kind]
    y, w = F.col(label).cast("double"), F.col(weight).cast("double") if weight else F.lit(1.0)
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features])
    long = rows.select(y.alias("y"), w.alias("w"), F.explode(pairs).alias("p")).where("p.v IS NOT NULL")
    values = long.groupBy("p.feature", "p.v").agg(
        F.sum("w").alias("n"), F.sum(F.col("w") * F.col("y")).alias("s"), F.sum(F.col("w") * F.col("y") * F.col("y")).alias("q")
    )
    ordered = Window.partitionBy("feature").orderBy("v")
    running, whole = ordered.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("feature")
    columns = {f"l{c}": F.sum(c).over(running) for c in "nsq"} | {f"t{c}": F.sum(c).over(whole) for c in "nsq"}
    at = values.withColumns(columns | {"next": F.lead("v").over(ordered)}).where("next IS NOT NULL")
    left, total = [F.col(f"l{c}") for c in "nsq"], [F.col(f"t{c}") for c in "nsq"]
    right = [t - a for t, a in zip(total, left, strict=True)]
    right[0] = F.nullif(right[0], F.lit(0.0))  # of the last value, which has no split
    inside = (left[0] * impurity(*left) + right[0] * impurity(*right)) / total[0]
    return at.select(
        "feature", ((F.col("v") + F.col("next")) / 2).alias("threshold"), (impurity(*total) - inside).alias("gain"),
        (left[1] / left[0]).alias("left_mean"), (right[1] / right[0]).alias("right_mean"), left[0].alias("n_left"), right[0].alias("n_right"),
    )


def best_split(rows: DataFrame, features: list[str], label: str, kind: str = "gini", weight: str | None = None) -> DataFrame:
    """The split with the largest gain, ties to the feature listed first and the smaller threshold; no row if none gains."""
    gains = split_gains(rows, features, label, kind, weight).where("gain > 0")
    listed = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature"))
    return gains.orderBy(F.desc("gain"), listed, "threshold").limit(1)


def boosted_stumps(rows: DataFrame, features: list[str], label: str, rounds: int = 2, step: float = 0.1) -> DataFrame:
    """One row per round: the stump that best fits what the rounds before leave, and its two leaf values.

    The first round fits the label with weight 1, each later one twice the residuals (the gradient of the squared error) with
    weight ``step``.  A stump is one row, so that rounds pass on four numbers.
    """
    spark, found = rows.sparkSession, []
    left = rows.withColumn("_left", F.col(label).cast("double"))
    for number in range(rounds):
        best = best_split(left, features, "_left", "variance").first()
        if best is None:
            break
        found.append((number, best["feature"], best["threshold"], best["left_mean"], best["right_mean"], 1.0 if number == 0 else step))
        predicted = F.lit(0.0)
        for _, feature, threshold, low, high, weight in found:
            predicted = predicted + weight * F.when(F.col(feature).cast("double") <= threshold, low).otherwise(high)
        left = rows.withColumn("_left", 2 * (F.col(label).cast("double") - predicted))
    return spark.createDataFrame(found, "round int, feature string, threshold double, low double, high double, weight double")
