"""Metrics of predictions, each from one aggregation."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.scale import positions


def confusion_matrix(predicted: DataFrame) -> DataFrame:
    counts = predicted.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy("label", "prediction")


def _share(part: Column, whole: Column) -> Column:
    """Ratio of counts; 0 where there is nothing to divide by."""
    return F.coalesce(part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0))


def classification_report(predicted: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of classes 0 and 1, their plain and support-weighted means, and accuracy."""
    said, true = F.col("prediction"), F.col("label")
    cells = predicted.agg(
        *[
            F.count_if((true == actual) & (said == guess)).alias(f"n{actual}{guess}")
            for actual in (0, 1)
            for guess in (0, 1)
        ]
    )

    def of(k: int) -> Column:
        other = 1 - k
        hit, missed, alarm = F.col(f"n{k}{k}"), F.col(f"n{k}{other}"), F.col(f"n{other}{k}")
        precision, recall = _share(hit, hit + alarm), _share(hit, hit + missed)
        return F.struct(
            precision.alias("precision"),
            recall.alias("recall"),
            _share(2 * hit, 2 * hit + alarm + missed).alias("f1"),
            (hit + missed).alias("support"),
        )

    both = cells.select("*", of(0).alias("c0"), of(1).alias("c1"))
    support = F.col("c0.support") + F.col("c1.support")

    def mean(kind: str, metric: str) -> Column:
        zero, one = F.col(f"c0.{metric}"), F.col(f"c1.{metric}")
        if kind == "macro avg":
            return (zero + one) / 2
        return _share(zero * F.col("c0.support") + one * F.col("c1.support"), support)

    def line(name: str, precision: Column, recall: Column, f1: Column, n: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            n.alias("support"),
        )

    right = _share(F.col("n00") + F.col("n11"), support)
    lines = [line(str(k), *[F.col(f"c{k}.{m}") for m in ("precision", "recall", "f1", "support")]) for k in (0, 1)]
    lines.append(line("accuracy", right, right, right, support))
    for kind in ("macro avg", "weighted avg"):
        lines.append(line(kind, *[mean(kind, m) for m in ("precision", "recall", "f1")], support))
    return both.select(F.explode(F.array(*lines)).alias("line")).select("line.*")


def regression_report(predicted: DataFrame, model: str = "model") -> DataFrame:
    """RMSE, MAE and R squared of ``predicted`` against ``actual``."""
    actual = F.col("actual").cast("double")
    error = actual - F.col("predicted").cast("double")
    sums = predicted.agg(
        F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"), F.var_pop(actual).alias("var")
    )
    return sums.select(
        F.lit(model).alias("model"),
        F.sqrt("mse").alias("rmse"),
        "mae",
        (1 - F.col("mse") / F.nullif("var", F.lit(0.0))).alias("r2"),
    )


def model_comparison(predictions: Mapping[str, DataFrame]) -> DataFrame:
    """One row per model, smallest error first."""
    rows = [regression_report(predicted, name) for name, predicted in predictions.items()]
    return reduce(DataFrame.unionByName, rows).orderBy("rmse")


def actual_vs_predicted(predicted: DataFrame) -> DataFrame:
    """Mean actual, mean predicted value and bias per tenth of the customers, by actual value.

    Rows are summed per actual value (in cents) first.  Customers of equal value stay together, so a value that many
    share may fill more than a tenth.
    """
    per_value = predicted.groupBy(F.col("actual").cast("decimal(18,2)").alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted")
    )
    placed = positions(per_value, "value")
    tenth = (F.floor(F.col("before") * 10 / F.col("total")) + 1).cast("int")
    tenths = placed.groupBy(tenth.alias("decile")).agg(
        F.sum("n").alias("n"), F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted")
    )
    return tenths.select(
        "decile",
        "n",
        (F.col("actual") / F.col("n")).alias("avg_actual"),
        (F.col("predicted") / F.col("n")).alias("avg_predicted"),
        ((F.col("predicted") - F.col("actual")) / F.col("n")).alias("bias"),
    ).orderBy("decile")
