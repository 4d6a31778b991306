"""Scoring, importance and dependence with models that are published as tables, and the SQL that scores with the same tables.

A fitted model cannot be repeated in SQL; one whose weights and nodes are given can, value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.models import evaluate, explain, score
from larkspur.models.tabular import INTERCEPT, NODES, WEIGHTS
from larkspur.oracles import HELD_OUT, ORACLES
from larkspur.plans import features
from larkspur.sources.star import AS_OF
from larkspur.sources.tables import Tables

SCORED_AT = datetime(2001, 12, 31)
Weights = dict[tuple[str, str | None], float]

# The published models.
CHURN: Weights = {
    (INTERCEPT, None): 1.1, ("tenure_months", None): -0.085, ("mrr", None): 0.004, ("total_events", None): -0.06,
    ("crm_emails_opened", None): -0.012, ("also_ecommerce", None): -0.45, ("engagement_rate", None): -1.7,
    ("plan_name", "Enterprise"): -0.6, ("plan_name", "Pro"): 0.25,
}
PROPENSITY: Weights = {
    (INTERCEPT, None): -0.9, ("account_age_months", None): 0.011, ("view_item_events", None): 0.21, ("distinct_sessions", None): 0.05,
    ("mobile_session_pct", None): -0.004, ("crm_emails_clicked", None): 0.033, ("acquisition_channel", "Google"): 0.4,
    ("acquisition_channel", "Meta"): -0.2, ("customer_type", "ecommerce"): 0.8, ("customer_type", "both"): 0.5,
}
VALUE_LINE: Weights = {
    (INTERCEPT, None): 8.5, ("account_age_months", None): 0.004, ("crm_emails_sent", None): 0.05, ("page_views", None): 0.01,
    ("customer_type", "saas"): -1.5,
}
# tree, node, feature, level, threshold, left, right, value, weight; values in log scale
VALUE_NODES = [
    (0, 0, "crm_emails_sent", None, 22.5, 1, 2, None, 1.0),
    (0, 1, "customer_type", "saas", 0.5, 3, 4, None, 1.0),
    (0, 2, "account_age_months", None, 40.0, 5, 6, None, 1.0),
    (0, 3, None, None, None, -1, -1, 10.75, 1.0),
    (0, 4, None, None, None, -1, -1, 6.25, 1.0),
    (0, 5, None, None, None, -1, -1, 12.5, 1.0),
    (0, 6, None, None, None, -1, -1, 13.125, 1.0),
    (1, 0, "view_item_events", None, 1.0, 1, 2, None, 0.5),
    (1, 1, None, None, None, -1, -1, 11.5, 0.5),
    (1, 2, "mobile_session_pct", None, 37.5, 3, 4, None, 0.5),
    (1, 3, None, None, None, -1, -1, 12.25, 0.5),
    (1, 4, None, None, None, -1, -1, 13.0, 0.5),
]
VALUE_DEPTH, REPEATS, SEED = 2, 4, 42
GRID = "tenure_months"


def _numbers(weights: Weights) -> list[str]:
    return [c for c, level in weights if level is None and c != INTERCEPT]


def _categories(weights: Weights) -> list[str]:
    return list(dict.fromkeys(c for c, level in weights if level is not None))


def _weight_rule(spark: SparkSession, weights: Weights) -> score.Rule:
    table = spark.createDataFrame([(c, level, w) for (c, level), w in weights.items()], WEIGHTS)
    return score.weight_rule(table, _numbers(weights), _categories(weights))


def _value_rule(spark: SparkSession) -> score.Rule:
    used = list(dict.fromkeys((c, level) for _, _, c, level, *_ in VALUE_NODES if c))
    return score.node_rule(spark.createDataFrame(VALUE_NODES, NODES), used, VALUE_DEPTH)


def _judge(weights: Weights, classes: bool = True) -> explain.Judge:
    return explain.linear_judge({k: w for k, w in weights.items() if k[0] != INTERCEPT}, weights[INTERCEPT, None], classes)


def _spark(t: Tables) -> SparkSession:
    return t.customers.sparkSession


def _scores(t: Tables) -> DataFrame:
    spark = _spark(t)
    rules = _weight_rule(spark, CHURN), _weight_rule(spark, PROPENSITY), _value_rule(spark)
    return score.score_customers_by(*rules, t, AS_OF, SCORED_AT).drop("scored_at")


def _people(t: Tables, column: str) -> DataFrame:
    spark = _spark(t)
    found = score.people_by(_weight_rule(spark, PROPENSITY), _value_rule(spark), t, AS_OF)
    return found.select("customer_id", F.round(column, 6).alias(column))


def _value_rows(t: Tables) -> DataFrame:
    rows = features.log_target(features.ltv_features(t, AS_OF)).drop("back")
    return rows.where(F.substring(F.md5(F.concat(F.col("customer_id").cast("string"), F.lit("-42"))), 1, 4) < "3333")


def _compared(t: Tables) -> DataFrame:
    """Three published predictors of value on the held-out customers, as models are compared."""
    spark, rows = _spark(t), _value_rows(t).withColumnRenamed("total_ltv", "actual")
    line, trees = _judge(VALUE_LINE, classes=False), _value_rule(spark)
    said = {
        "linear": line.decide(line.encode(rows)).withColumn("predicted", F.expm1("prediction")),
        "trees": trees(rows).withColumn("predicted", F.expm1("score")),
        "constant": rows.withColumn("predicted", F.lit(150_000.0)),
    }
    found = evaluate.model_comparison({name: p.select("actual", "predicted") for name, p in said.items()})
    return found.select("model", *[F.round(c, 4).alias(c) for c in ("rmse", "mae", "r2")])


def _importance(t: Tables, which: str) -> DataFrame:
    if which == "recall":
        rows, judge, label = features.churn_features(t, AS_OF), _judge(CHURN), "churned"
    else:
        rows, judge, label = _value_rows(t), _judge(VALUE_LINE, classes=False), "log_ltv"
    found = explain.permutation_importance(judge, rows, "customer_id", label, which, REPEATS, SEED)
    return found.select("feature", F.round("importance_mean", 6).alias("importance_mean"), F.round("importance_std", 6).alias("importance_std"))


def _dependence(t: Tables) -> DataFrame:
    found = explain.partial_dependence(_judge(CHURN), features.churn_features(t, AS_OF), GRID, size=1_000)
    return found.select("feature", "grid_value", F.round("avg_prediction", 6).alias("avg_prediction"))


FIXED_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "score_churn_fixed": lambda t: score.churn_by(_weight_rule(_spark(t), CHURN), t, AS_OF).select(
        "customer_id", F.round("churn_risk_score", 6).alias("churn_risk_score")
    ),
    "score_propensity_fixed": lambda t: _people(t, "purchase_propensity_score"),
    "score_ltv_fixed": lambda t: _people(t, "predicted_ltv"),
    "batch_score_customers_fixed": _scores,
    "model_comparison_fixed": _compared,
    "permutation_importance_fixed": lambda t: _importance(t, "recall"),
    "permutation_importance_fixed_r2": lambda t: _importance(t, "r2"),
    "partial_dependence_fixed": _dependence,
}


# --- the same in SQL ----------------------------------------------------------------------------------------------


def _term(column: str, level: str | None, value: str | None = None) -> str:
    if level is None:
        return value or f"CAST({column} AS DOUBLE)"
    return f"(CASE WHEN {column} = '{level}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"


def _margin(weights: Weights) -> str:
    return " + ".join(f"{w!r}::DOUBLE" + ("" if c == INTERCEPT else f" * {_term(c, level)}") for (c, level), w in weights.items())


def _logistic(weights: Weights) -> str:
    return f"1 / (1 + exp(-({_margin(weights)})))"


_PEOPLE, _SUBSCRIBERS = ORACLES["propensity_scoring_features"], ORACLES["churn_scoring_features"]
_CHURN_ROWS = ORACLES["churn_features"]
_VALUE_ROWS = f"SELECT *, ln(1 + total_ltv) AS log_ltv FROM ({ORACLES['ltv_features']}) v WHERE {HELD_OUT}"


def _nodes() -> str:
    shown = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else repr(v)
    return ",\n  ".join("(" + ", ".join(map(shown, row)) + ")" for row in VALUE_NODES)


def _walk(people: str) -> str:
    """``leaves(customer_id, score)``: every customer walks every tree, a node a round."""
    used = dict.fromkeys((c, level) for _, _, c, level, *_ in VALUE_NODES if c)
    value = " ".join(f"WHEN '{c}{level or ''}' THEN {_term(c, level)}" for c, level in used)
    return f"""WITH RECURSIVE people AS ({people}),
nodes(tree, node, feature, level, threshold, low, high, leaf, weight) AS (VALUES
  {_nodes()}),
walk AS (
  SELECT customer_id, tree, 0 AS node FROM people, (SELECT DISTINCT tree FROM nodes) t
  UNION ALL
  SELECT w.customer_id, w.tree,
    CASE WHEN (CASE n.feature || coalesce(n.level, '') {value} END) <= n.threshold THEN n.low ELSE n.high END
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node JOIN people p ON p.customer_id = w.customer_id
  WHERE n.low >= 0),
leaves AS (
  SELECT w.customer_id, CAST(sum(n.weight * n.leaf) / sum(n.weight) AS DOUBLE) AS score
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE n.low < 0 GROUP BY w.customer_id)
"""


def _importance_sql(rows: str, weights: Weights, label: str, metric: str) -> str:
    """Every feature of every row replaced by that of the row its number leads to, and all rows judged again."""
    own = {k: w for k, w in weights.items() if k[0] != INTERCEPT}
    names = [c if level is None else f"{c}_{level}" for c, level in own]
    vector = "[" + ", ".join(_term(c, level) for c, level in own) + "]"
    values = "[" + ", ".join(f"{w!r}::DOUBLE" for w in own.values()) + "]"
    intercept = f"{weights[INTERCEPT, None]!r}::DOUBLE"
    if metric == "recall":
        judged = f"CASE WHEN {intercept} + list_inner_product(x, {values}) > 0 THEN 1.0 ELSE 0.0 END"
        measure = "CAST(count(*) FILTER (y = 1 AND p = 1) AS DOUBLE) / nullif(count(*) FILTER (y = 1), 0)"
    else:
        judged = f"{intercept} + list_inner_product(x, {values})"
        measure = "1 - sum((y - p) * (y - p)) / nullif(var_pop(y) * count(*), 0)"
    return f"""WITH numbered AS (
  SELECT {vector} AS x, CAST({label} AS DOUBLE) AS y,
    row_number() OVER (ORDER BY substr(md5(CAST(customer_id AS VARCHAR)), 1, 4), customer_id) - 1 AS i, count(*) OVER () AS n
  FROM ({rows}) r),
sizes AS (SELECT max(n) AS n FROM numbered),
steps AS (
  SELECT r, n, 1 + (r * {explain.STEP} + {SEED}) % n AS first, (r * {explain.OFFSET} + {SEED}) % n AS b FROM sizes, range(1, {REPEATS + 1}) AS repeats(r)),
maps AS (SELECT r, n, b, (SELECT min(a) FROM range(first, first + 1000) AS tried(a) WHERE gcd(a, n) = 1) AS a FROM steps),
names AS (SELECT unnest([{", ".join(f"'{n}'" for n in names)}]) AS feature, unnest(range(1, {len(names) + 1})) AS f),
base AS (SELECT {measure} AS whole FROM (SELECT y, {judged} AS p FROM numbered) q),
swapped AS (
  SELECT feature, r, o.y, list_concat(list_concat(o.x[:f - 1], [d.x[f]]), o.x[f + 1:]) AS x
  FROM numbered o, maps m, numbered d, names WHERE d.i = (o.i::HUGEINT * m.a + m.b) % m.n),
again AS (SELECT feature, r, {measure} AS part FROM (SELECT feature, r, y, {judged} AS p FROM swapped) q GROUP BY feature, r)
SELECT feature, round(avg(whole - part), 6) AS importance_mean, round(stddev_pop(whole - part), 6) AS importance_std
FROM again, base GROUP BY feature"""


def _regression(name: str, source: str) -> str:
    return f"""SELECT '{name}' AS model, round(sqrt(avg((a - p) * (a - p))), 4) AS rmse, round(avg(abs(a - p)), 4) AS mae,
  round(1 - avg((a - p) * (a - p)) / var_pop(a), 4) AS r2 FROM ({source}) q"""


_LEAVES = _walk(_PEOPLE)
_RISK = f"SELECT customer_id, max({_logistic(CHURN)}) AS risk FROM ({_SUBSCRIBERS}) s GROUP BY customer_id"

FIXED_ORACLES: dict[str, str] = {
    "score_churn_fixed": f"SELECT customer_id, round(risk, 6) AS churn_risk_score FROM ({_RISK}) r",
    "score_propensity_fixed": f"SELECT customer_id, round({_logistic(PROPENSITY)}, 6) AS purchase_propensity_score FROM ({_PEOPLE}) p",
    "score_ltv_fixed": f"{_LEAVES} SELECT customer_id, round(exp(score) - 1, 6) AS predicted_ltv FROM leaves",
    "batch_score_customers_fixed": f"""{_LEAVES} SELECT customer_id, CAST(CAST(risk AS DECIMAL(5,4)) AS DOUBLE) AS churn_risk_score,
  CAST(CAST({_logistic(PROPENSITY)} AS DECIMAL(5,4)) AS DOUBLE) AS purchase_propensity_score,
  CAST(CAST(exp(score) - 1 AS DECIMAL(12,2)) AS DOUBLE) AS predicted_ltv
FROM people JOIN leaves USING (customer_id) FULL JOIN ({_RISK}) r USING (customer_id)""",
    "model_comparison_fixed": f"""{_walk(_VALUE_ROWS)}
{_regression("linear", f"SELECT total_ltv AS a, exp({_margin(VALUE_LINE)}) - 1 AS p FROM people")}
UNION ALL {_regression("trees", "SELECT total_ltv AS a, exp(score) - 1 AS p FROM people JOIN leaves USING (customer_id)")}
UNION ALL {_regression("constant", "SELECT total_ltv AS a, 150000.0::DOUBLE AS p FROM people")}""",
    "permutation_importance_fixed": _importance_sql(_CHURN_ROWS, CHURN, "churned", "recall"),
    "permutation_importance_fixed_r2": _importance_sql(_VALUE_ROWS, VALUE_LINE, "log_ltv", "r2"),
    "partial_dependence_fixed": f"""WITH seen AS ({_CHURN_ROWS}), grid AS (SELECT DISTINCT CAST({GRID} AS DOUBLE) AS grid_value FROM seen)
SELECT '{GRID}' AS feature, grid_value, round(avg(chance), 6) AS avg_prediction
FROM (SELECT grid_value, {_logistic(CHURN)} AS chance FROM (SELECT s.* REPLACE (g.grid_value AS {GRID}), g.grid_value FROM seen s, grid g) m) c
GROUP BY grid_value""",
}
