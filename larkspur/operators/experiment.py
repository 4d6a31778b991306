"""Two-variant experiments: z statistic, p value, decision, lift."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators.aggregates import ab_conversion, variant_counts
from larkspur.sources.tables import Tables


def _two_rates(t: Tables, experiment: str | None) -> DataFrame:
    """One row: assigned and converted of A and B, and their rates."""
    def of(variant: str, column: str):
        picked = F.when(F.col("variant") == variant, F.col(column))
        return F.coalesce(F.sum(picked), F.lit(0)).cast("double").alias(f"{column[6:]}_{variant.lower()}")

    wide = variant_counts(t, experiment).agg(
        *[of(v, c) for v in ("A", "B") for c in ("total_assigned", "total_converted")]
    )
    none = F.lit(0.0)
    return wide.withColumn("rate_a", F.col("converted_a") / F.nullif("assigned_a", none)).withColumn(
        "rate_b", F.col("converted_b") / F.nullif("assigned_b", none)
    )


def ab_z_test(t: Tables, experiment: str | None = None) -> DataFrame:
    """Pooled two-proportion z statistic of A against B."""
    pooled = (F.col("converted_a") + F.col("converted_b")) / F.nullif(
        F.col("assigned_a") + F.col("assigned_b"), F.lit(0.0)
    )
    rates = _two_rates(t, experiment).withColumn("pooled", pooled)
    spread = F.sqrt(F.col("pooled") * (1 - F.col("pooled")) * (1 / F.nullif("assigned_a", F.lit(0.0)) + 1 / F.nullif("assigned_b", F.lit(0.0))))
    z = (F.col("rate_a") - F.col("rate_b")) / F.nullif(spread, F.lit(0.0))
    return rates.select("rate_a", "rate_b", z.alias("z"))


def ab_p_value(t: Tables, experiment: str | None = None) -> DataFrame:
    """Two-sided p value.  Chi-square on the 2 x 2 table equals z squared and has the same p, without continuity
    correction; Spark counts the table on the executors."""
    rows = t.ab_test_assignments if experiment is None else t.ab_test_assignments.where(
        F.col("experiment_name") == experiment
    )
    coded = rows.where(F.col("variant").isin("A", "B") & F.col("converted").isNotNull()).select(
        F.col("converted").cast("double").alias("label"), (F.col("variant") == "B").cast("double").alias("in_b")
    )
    vectors = VectorAssembler(inputCols=["in_b"], outputCol="features").transform(coded)
    tested = ChiSquareTest.test(vectors, "features", "label", flatten=True)
    return tested.select(F.col("statistic").alias("chi_square"), F.col("pValue").alias("p_value"))


def ab_decision(t: Tables, alpha: float = 0.05, experiment: str | None = None) -> DataFrame:
    """Both rates in percent, the lift in points, and whether the difference is significant at ``alpha``."""
    bound = NormalDist().inv_cdf(1 - alpha / 2)
    z = ab_z_test(t, experiment)
    return z.select(
        F.round(F.col("rate_a") * 100, 2).alias("rate_a"),
        F.round(F.col("rate_b") * 100, 2).alias("rate_b"),
        F.round((F.col("rate_b") - F.col("rate_a")) * 100, 2).alias("lift_pt"),
        "z",
        (F.abs("z") > bound).alias("significant"),
    )


def ab_lift(t: Tables, experiment: str | None = None) -> DataFrame:
    """Percentage points between the published (rounded) conversion rates of B and A."""
    def rate(variant: str):
        return F.max(F.when(F.col("variant") == variant, F.col("conversion_rate_pct")))

    return ab_conversion(t, experiment).agg((rate("B") - rate("A")).alias("lift_pt"))
