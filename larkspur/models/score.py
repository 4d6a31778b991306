"""Batch scoring: three models, one score table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.models.tabular import chance, linear_margin, tree_score
from larkspur.models.train import predict_class, predict_value
from larkspur.operators.scale import dealt
from larkspur.plans.features import churn_scoring_features, propensity_scoring_features
from larkspur.sources.sinks import full_refresh, typed
from larkspur.sources.tables import Tables


def score_churn(model: PipelineModel, t: Tables, as_of: date, compat_zero_fill: bool = False) -> DataFrame:
    """Churn risk of active subscribers; the highest one for a customer with several subscriptions."""
    scored = predict_class(model, churn_scoring_features(t, as_of, compat_zero_fill))
    return scored.groupBy("customer_id").agg(F.max("probability").alias("churn_risk_score"))


def score_propensity(model: PipelineModel, features: DataFrame) -> DataFrame:
    return predict_class(model, features).select("customer_id", F.col("probability").alias("purchase_propensity_score"))


def score_ltv(model: PipelineModel, features: DataFrame) -> DataFrame:
    return predict_value(model, features).select("customer_id", F.col("predicted").alias("predicted_ltv"))


Rule = Callable[[DataFrame], DataFrame]  # adds the column ``score``


def weight_rule(weights: DataFrame, numbers: list[str], categories: list[str]) -> Rule:
    """A probability from a weight table."""
    return lambda rows: linear_margin(rows, weights, numbers, categories).withColumn("score", chance(F.col("margin"))).drop("margin")


def node_rule(nodes: DataFrame, features: list[tuple[str, str | None]], depth: int, mean: bool = True) -> Rule:
    """The mean or the sum of the trees of a node table."""
    return lambda rows: tree_score(dealt(rows), nodes, features, depth, mean)


def churn_by(rule: Rule, t: Tables, as_of: date) -> DataFrame:
    scored = rule(churn_scoring_features(t, as_of))
    return scored.groupBy("customer_id").agg(F.max("score").alias("churn_risk_score"))


def people_by(propensity: Rule, value: Rule, t: Tables, as_of: date) -> DataFrame:
    """``customer_id``, ``purchase_propensity_score``, ``predicted_ltv``; ``value`` scores in log scale."""
    first = propensity(propensity_scoring_features(t, as_of)).withColumnRenamed("score", "purchase_propensity_score")
    return value(first).select("customer_id", "purchase_propensity_score", F.expm1("score").alias("predicted_ltv"))


def score_customers_by(churn: Rule, propensity: Rule, value: Rule, t: Tables, as_of: date, scored_at: datetime) -> DataFrame:
    """Rows of the score table from models kept as tables; no fitted model is needed."""
    return _score_rows(people_by(propensity, value, t, as_of), churn_by(churn, t, as_of), scored_at)


def _score_rows(people: DataFrame, risks: DataFrame, scored_at: datetime) -> DataFrame:
    merged = people.join(risks, "customer_id", "full_outer")
    return typed(merged.withColumn("scored_at", F.lit(scored_at).cast("timestamp")), "customer_scores")


def score_customers(
    churn: PipelineModel, propensity: PipelineModel, ltv: PipelineModel, t: Tables, as_of: date, scored_at: datetime
) -> DataFrame:
    """Rows of the score table.  Two models run over the customer features one after the other, in one pass; only the
    churn scores, of active subscribers, are joined."""
    people = score_both(propensity, ltv, propensity_scoring_features(t, as_of))
    return _score_rows(people, score_churn(churn, t, as_of), scored_at)


def score_both(propensity: PipelineModel, ltv: PipelineModel, features: DataFrame) -> DataFrame:
    """``customer_id``, ``purchase_propensity_score``, ``predicted_ltv`` from one pass over the rows."""
    first = propensity.transform(features).withColumn("purchase_propensity_score", vector_to_array("probability")[1])
    second = ltv.transform(first.select(*features.columns, "purchase_propensity_score"))
    return second.select("customer_id", "purchase_propensity_score", F.expm1("prediction").alias("predicted_ltv"))


def batch_score_customers(
    churn_path: str,
    propensity_path: str,
    ltv_path: str,
    t: Tables,
    as_of: date,
    scored_at: datetime,
    table: str,
    folder: str,
) -> str:
    """Load the saved models, score every customer and swap the new scores in."""
    models = [PipelineModel.load(path) for path in (churn_path, propensity_path, ltv_path)]
    return full_refresh(score_customers(*models, t, as_of, scored_at), table, folder)
