"""Facts that hold for a correctly trained model whatever library trained it, each as a query and as SQL over the tables.

Where a fit is small enough to be worked out in SQL (one exact tree, two rounds of stumps) its values are compared.  Larger fits
are checked by what defines them: every weight of a logistic model solves its score equation, least squares keeps the
moments of the target, and every score, importance and comparison equals what the model's weights and nodes, read back as tables,
give by column functions alone (larkspur/models/tabular.py, itself compared with SQL on published models).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.models import explain, score, splits, tabular, train
from larkspur.models.prepare import with_class_weights
from larkspur.operators.scale import dealt
from larkspur.oracles import HELD_OUT, ORACLES
from larkspur.plans import features
from larkspur.sources.star import AS_OF

Lab = object  # catalog.Lab; not imported, as the catalog imports this module
CLOSE = 1e-9


def _same(a: str, b: str) -> Column:
    """Whether two columns are both null or as good as equal."""
    near = F.abs(F.col(a) - F.col(b)) <= CLOSE * F.greatest(F.lit(1.0), F.abs(F.col(b)))
    return (F.col(a).isNull() & F.col(b).isNull()) | F.coalesce(near, F.lit(False))


def _residuals(spark: SparkSession, name: str, study: train.Study, model: PipelineModel, balanced: bool) -> DataFrame:
    """How far each coefficient is from solving its score equation, to three places."""
    rows = with_class_weights(study.train, study.label) if balanced else study.train
    found = tabular.score_equations(
        rows, tabular.weight_table(spark, model), list(study.numeric), list(study.categories), study.label, "weight" if balanced else None
    )
    return found.select(F.lit(name).alias("model"), _named(), F.round("residual", 3).alias("residual"))


def _named() -> Column:
    return F.when(F.col("level").isNull(), F.col("feature")).otherwise(F.concat_ws("_", "feature", "level")).alias("feature")


def _churn_logistic(spark: SparkSession, m: Lab) -> DataFrame:
    raw, rate = m.churn_raw(), m.churn()
    fits = [("unweighted", raw, False), ("balanced", raw, True), ("balanced with engagement_rate", rate, True)]
    parts = [_residuals(spark, name, s, train.logistic(s, balanced), balanced) for name, s, balanced in fits]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _propensity_logistic(spark: SparkSession, m: Lab) -> DataFrame:
    s = m.propensity()
    plain = _residuals(spark, "unweighted", s, train.logistic(s), False)
    return plain.unionByName(_residuals(spark, "balanced", s, m.propensity_balanced(), True))


def _coefficients(spark: SparkSession, m: Lab) -> DataFrame:
    """The ranking's own values, put back into the score equations; and whether they stand in order."""
    model, study = m.propensity_balanced(), m.propensity()
    ranked = explain.coefficient_ranking(spark, model)
    places = [(c if level is None else f"{c}_{level}", c, level) for c, level in tabular.places(model)]
    named = spark.createDataFrame(places, "name string, column string, level string")
    weights = ranked.join(F.broadcast(named), F.col("feature") == F.col("name")).select(  # a row per place
        F.col("column").alias("feature"), "level", F.col("value").alias("weight")
    )
    weights = weights.union(spark.createDataFrame([(tabular.INTERCEPT, None, float(model.stages[-1].intercept))], tabular.WEIGHTS))
    rows = with_class_weights(study.train, study.label)
    found = tabular.score_equations(rows, weights, list(study.numeric), list(study.categories), study.label, "weight")
    above = ranked.select((F.col("rank") + 1).alias("rank"), F.col("value").alias("above"))
    order = ranked.join(above, "rank", "left").select(F.col("feature").alias("f"), F.coalesce(F.col("above") >= F.col("value"), F.lit(True)).alias("in_order"))
    told = found.where(F.col("feature") != tabular.INTERCEPT).select(_named(), F.round("residual", 3).alias("residual"))
    return told.join(order, F.col("feature") == F.col("f")).select("feature", "residual", "in_order")


def _linear_facts(m: Lab) -> DataFrame:
    """Mean of feature times prediction over the training rows, which least squares keeps equal to that of the target."""
    study = m.ltv()
    rows = m.ltv_linear().transform(study.train)
    sums = [F.struct(F.lit(c).alias("feature"), F.round(F.avg(F.col(c) * F.col("prediction")), 3).alias("moment")) for c in study.numeric]
    whole = F.struct(F.lit("(intercept)").alias("feature"), F.round(F.avg("prediction"), 3).alias("moment"))
    return rows.agg(F.array(whole, *sums).alias("parts")).select(F.explode("parts").alias("p")).select("p.*")


def _forest_rows(m: Lab) -> DataFrame:
    """Every held-out row with its label, and whether its probability and class are those the model's nodes give."""
    model, rows = m.churn_forest(), m.churn().test
    told = train.predict_class(model, rows.withColumn("customer_id", F.col("subscription_id")), "churned")
    by = tabular.tree_score(dealt(rows), m.churn_nodes(), tabular.places(model), train.TREE_DEPTH).select("subscription_id", "customer_id", "score")
    joined = told.withColumnRenamed("customer_id", "subscription_id").join(by, "subscription_id", "full_outer")
    agrees = (F.col("score") > 0.5) == (F.col("prediction") == 1)
    return joined.select("customer_id", "label", _same("probability", "score").alias("as_nodes"), agrees.alias("agrees"))


def _value_rows(m: Lab, model: PipelineModel, nodes: DataFrame, depth: int, mean: bool) -> DataFrame:
    """Every held-out row with its value, and whether the prediction is the one the model's nodes give."""
    by = tabular.tree_score(dealt(m.ltv().test), nodes, tabular.places(model), depth, mean).select("customer_id", F.expm1("score").alias("score"))
    joined = m.value_predictions(model).join(by, "customer_id", "full_outer")
    return joined.select("customer_id", F.round("actual", 2).alias("actual"), _same("predicted", "score").alias("as_nodes"))


def _exact(m: Lab, which: str) -> train.Study:
    """A study by its numbers that take few values."""
    study = m.churn_raw() if which == "churn" else m.ltv()
    return replace(study, categories=())


def _root(nodes: DataFrame) -> DataFrame:
    return nodes.where("node = 0").select("feature", F.round("threshold", 6).alias("threshold"), F.round("gain", 6).alias("gain"))


def _searched(split: DataFrame) -> DataFrame:
    return split.select("feature", F.round("threshold", 6).alias("threshold"), F.round("gain", 6).alias("gain"))


def _two_rounds(m: Lab) -> DataFrame:
    study = _exact(m, "ltv")
    scored = train.boosting(study, rounds=2, depth=1, bins=train.EXACT_BINS).transform(study.test)
    return scored.select("customer_id", F.round("prediction", 6).alias("prediction"))


def _two_stumps(m: Lab) -> DataFrame:
    study = _exact(m, "ltv")
    found = splits.boosted_stumps(study.train, list(study.numeric), "log_ltv", 2, train.BOOST_STEP)
    return found.select("round", "feature", *[F.round(c, 6).alias(c) for c in ("threshold", "low", "high")])


def _variance(rows: DataFrame) -> DataFrame:
    """rmse and r2 together give back the variance of the actual values, whichever the model."""
    variance = F.round(F.col("rmse") * F.col("rmse") / (1 - F.col("r2")), 2)
    return rows.select("model", variance.alias("variance"))


def _impurity(spark: SparkSession, m: Lab) -> DataFrame:
    """Every feature of the model, and whether its importance is the one that gains and sizes of the nodes add up to."""
    by = tabular.importance_from_nodes(m.churn_nodes()).select(_named(), F.col("value").alias("by_nodes"))
    told = explain.impurity_importance(spark, m.churn_forest()).join(by, "feature", "left").na.fill(0.0, ["by_nodes"])
    return told.select("feature", _same("value", "by_nodes").alias("as_nodes"))


def _importance(m: Lab, which: str) -> DataFrame:
    """Every feature, and whether its importance is the same when the model's own table judges the shuffled rows."""
    if which == "propensity":
        model, study = m.propensity_balanced(), m.propensity()
        fitted = model.stages[-1]
        weights = dict(zip(tabular.places(model), fitted.coefficients.toArray().tolist(), strict=True))
        judge = explain.linear_judge(weights, fitted.intercept)
    elif which == "churn":
        model, study = m.churn_forest(), m.churn()
        judge = explain.tree_judge(m.churn_nodes(), tabular.places(model), train.TREE_DEPTH)
    else:
        model, study = m.ltv_forest(), m.ltv()
        judge = explain.tree_judge(m.ltv_nodes(), tabular.places(model), train.TREE_DEPTH, classes=False)
    metric = "r2" if which == "ltv" else "recall"
    again = explain.permutation_importance(judge, study.test, study.key, study.label, metric)
    both = m.importance(which).join(again.select("feature", F.col("importance_mean").alias("m"), F.col("importance_std").alias("s")), "feature", "full_outer")
    return both.select("feature", (_same("importance_mean", "m") & _same("importance_std", "s")).alias("as_table"))


def _saved(m: Lab, again: DataFrame) -> DataFrame:
    """Held-out rows, and how many are scored otherwise by the model that was saved and loaded."""
    before = train.predict_class(m.churn_forest(), m.churn().test, "churned").withColumnRenamed("probability", "was")
    both = before.select("customer_id", "was").join(again.select("customer_id", "probability"), "customer_id", "full_outer")
    return both.agg(F.count("*").alias("n"), F.count_if(~F.col("was").eqNullSafe(F.col("probability"))).alias("differing"))


def _rules(spark: SparkSession, m: Lab) -> tuple[score.Rule, score.Rule, score.Rule]:
    """The three trained models as tables."""
    return (_churn_rule(m), *_people_rules(spark, m))


def _churn_rule(m: Lab) -> score.Rule:
    return score.node_rule(m.churn_nodes(), tabular.places(m.churn_forest()), train.TREE_DEPTH)


def _people_rules(spark: SparkSession, m: Lab) -> tuple[score.Rule, score.Rule]:
    s = m.propensity()
    return (
        score.weight_rule(tabular.weight_table(spark, m.propensity_balanced()), list(s.numeric), list(s.categories)),
        score.node_rule(m.ltv_nodes(), tabular.places(m.ltv_forest()), train.TREE_DEPTH),
    )


def _as_table(told: DataFrame, by: DataFrame, column: str) -> DataFrame:
    """Every customer scored, and whether the score is the one the model's table gives."""
    other = by.select("customer_id", F.col(column).alias("by"))
    return told.join(other, "customer_id", "full_outer").select("customer_id", _same(column, "by").alias("as_table"))


def _scored_churn(spark: SparkSession, m: Lab) -> DataFrame:
    return _as_table(score.score_churn(m.churn_forest(), m.t, AS_OF), score.churn_by(_churn_rule(m), m.t, AS_OF), "churn_risk_score")


def _scored_people(spark: SparkSession, m: Lab, column: str) -> DataFrame:
    rows = features.propensity_scoring_features(m.t, AS_OF)
    told = score.score_propensity(m.propensity_balanced(), rows) if column == "purchase_propensity_score" else score.score_ltv(m.ltv_forest(), rows)
    return _as_table(told, score.people_by(*_people_rules(spark, m), m.t, AS_OF), column)


def _score_facts(spark: SparkSession, m: Lab) -> DataFrame:
    """Every customer with a score: which of the three there are, and whether the models' tables give the same row."""
    columns = ["churn_risk_score", "purchase_propensity_score", "predicted_ltv"]
    told = m.scores()
    by = score.score_customers_by(*_rules(spark, m), m.t, AS_OF, score.datetime(2001, 12, 31))
    by = by.select("customer_id", *[F.col(c).alias(f"by_{c}") for c in columns])
    # Stored scores are decimals: two ways to add up doubles may end on either side of a half.
    near = lambda c, unit: F.coalesce(F.abs(F.col(c) - F.col(f"by_{c}")) <= unit, F.col(c).isNull() & F.col(f"by_{c}").isNull())
    same = near(columns[0], 0.0001) & near(columns[1], 0.0001) & near(columns[2], 0.01)
    return told.join(by, "customer_id", "full_outer").select(
        "customer_id",
        F.col("churn_risk_score").isNotNull().alias("has_churn"),
        F.col("purchase_propensity_score").isNotNull().alias("has_propensity"),
        F.col("predicted_ltv").isNotNull().alias("has_ltv"),
        same.alias("as_tables"),
    )


def _balanced(study: train.Study) -> DataFrame:
    return with_class_weights(study.train, study.label)


def fact_queries(save_and_back: Callable[[Lab], DataFrame]) -> dict[str, Callable[[SparkSession, Lab], DataFrame]]:
    churn, value = lambda m: _exact(m, "churn"), lambda m: _exact(m, "ltv")
    return {
        "churn_forest_facts": lambda spark, m: _forest_rows(m),
        "churn_logistic_facts": _churn_logistic,
        "propensity_logistic_facts": _propensity_logistic,
        "ltv_linear_facts": lambda spark, m: _linear_facts(m),
        "ltv_forest_facts": lambda spark, m: _value_rows(m, m.ltv_forest(), m.ltv_nodes(), train.TREE_DEPTH, True),
        "ltv_boosting_facts": lambda spark, m: _value_rows(m, m.ltv_boosting(), m.boosting_nodes(), train.BOOST_DEPTH, False),
        "churn_tree_root": lambda spark, m: _root(tabular.node_table(spark, train.whole_tree(churn(m), 1))),
        "ltv_tree_root": lambda spark, m: _root(tabular.node_table(spark, train.whole_tree(value(m), 1, classes=False))),
        "churn_best_split": lambda spark, m: _searched(splits.best_split(_balanced(churn(m)), train.CHURN_RAW, "churned", weight="weight")),
        "ltv_best_split": lambda spark, m: _searched(splits.best_split(value(m).train, train.CUSTOMER_NUMBERS, "log_ltv", "variance")),
        "boosting_two_rounds": lambda spark, m: _two_rounds(m),
        "boosted_stumps": lambda spark, m: _two_stumps(m),
        "model_comparison_facts": lambda spark, m: _variance(m.comparison()),
        "coefficient_ranking_facts": _coefficients,
        "impurity_importance_facts": _impurity,
        "permutation_importance_facts": lambda spark, m: _importance(m, "churn"),
        "permutation_importance_propensity_facts": lambda spark, m: _importance(m, "propensity"),
        "permutation_importance_ltv_facts": lambda spark, m: _importance(m, "ltv"),
        "save_load_model_facts": lambda spark, m: _saved(m, save_and_back(m)),
        "score_churn_facts": _scored_churn,
        "score_propensity_facts": lambda spark, m: _scored_people(spark, m, "purchase_propensity_score"),
        "score_ltv_facts": lambda spark, m: _scored_people(spark, m, "predicted_ltv"),
        "batch_score_customers_facts": _score_facts,
    }


def _split(table: str, label: str) -> str:
    """Feature rows with the side they are on: a fifth of each class by hash."""
    return f"""(SELECT *, row_number() OVER (PARTITION BY {label}
      ORDER BY md5(concat(CAST(customer_id AS VARCHAR), '-42')), customer_id)
    <= round(0.2 * count(*) OVER (PARTITION BY {label})) AS is_test FROM ({ORACLES[table]}) f)"""


_CHURN, _PROPENSITY = _split("churn_features", "churned"), _split("propensity_features", "purchased")
_VALUE = f"(SELECT *, {HELD_OUT} AS is_test, ln(1 + total_ltv) AS log_ltv FROM ({ORACLES['ltv_features']}) f)"


def _features(split: str, numbers: list[str], categories: list[str]) -> str:
    """Numbers, then every level of a category in the training rows but the first."""
    parts = [f"SELECT '{c}' AS feature" for c in numbers]
    for c in categories:
        level = f"SELECT DISTINCT {c} AS level FROM {split} s WHERE NOT is_test AND {c} IS NOT NULL"
        parts.append(f"SELECT '{c}_' || level FROM ({level}) l WHERE level > (SELECT min(level) FROM ({level}) first_one)")
    return "\nUNION ALL ".join(parts)


def _gains(rows: str, columns: list[str], kind: str) -> str:
    """Every split between neighbouring values of ``rows(y, w, columns)``, by running sums: ``gains(feature, place, threshold, gain, low, high)``."""
    impurity = (lambda n, s, q: f"(1 - ({s} / {n}) ^ 2 - (1 - {s} / {n}) ^ 2)") if kind == "gini" else (lambda n, s, q: f"({q} / {n} - ({s} / {n}) ^ 2)")
    listed = ", ".join(f"{{'feature': '{c}', 'place': {i}, 'v': CAST({c} AS DOUBLE)}}" for i, c in enumerate(columns))
    return f"""(SELECT feature, place, (v + following) / 2 AS threshold, s / n AS low, (ts - s) / (tn - n) AS high,
  {impurity("tn", "ts", "tq")} - (n * {impurity("n", "s", "q")} + (tn - n) * {impurity("(tn - n)", "(ts - s)", "(tq - q)")}) / tn AS gain
FROM (
  SELECT feature, place, v, lead(v) OVER by_value AS following, sum(n) OVER by_value AS n, sum(s) OVER by_value AS s, sum(q) OVER by_value AS q,
    sum(n) OVER (PARTITION BY feature) AS tn, sum(s) OVER (PARTITION BY feature) AS ts, sum(q) OVER (PARTITION BY feature) AS tq
  FROM (SELECT p.feature, p.place, p.v, sum(w) AS n, sum(w * y) AS s, sum(w * y * y) AS q
        FROM (SELECT y, w, unnest([{listed}]) AS p FROM ({rows}) r) u GROUP BY ALL) g
  WINDOW by_value AS (PARTITION BY feature ORDER BY v)) c
WHERE following IS NOT NULL)"""


def _best(rows: str, columns: list[str], kind: str) -> str:
    return f"SELECT * FROM {_gains(rows, columns, kind)} g ORDER BY gain DESC, place, threshold LIMIT 1"


_CHURN_NAMES = _features(_CHURN, train.CHURN_RATE, ["plan_name"])
_PEOPLE_NAMES = _features(_PROPENSITY, train.CUSTOMER_NUMBERS, train.CUSTOMER_CATEGORIES)
_VALUE_NAMES = _features(_VALUE, train.CUSTOMER_NUMBERS, train.CUSTOMER_CATEGORIES)
_ACTUAL = f"SELECT customer_id, round(total_ltv, 2) AS actual, TRUE AS {{0}} FROM {_VALUE} s WHERE is_test"
_CHURN_WEIGHTED = f"""SELECT *, CAST(churned AS DOUBLE) AS y, CAST(count(*) OVER () AS DOUBLE) / (2 * count(*) OVER (PARTITION BY churned)) AS w
FROM {_CHURN} s WHERE NOT is_test"""
_VALUE_SEEN = f"SELECT *, log_ltv AS y, 1.0::DOUBLE AS w FROM {_VALUE} s WHERE NOT is_test"
_SHOWN = "feature, round(threshold, 6) AS threshold, round(gain, 6) AS gain"


def _zeros(model: str, names: str) -> str:
    return f"SELECT '{model}' AS model, feature, CAST(0 AS DOUBLE) AS residual FROM (SELECT '(intercept)' AS feature UNION ALL {names}) n"


def _number(column_of: str) -> str:
    """A row's value of the feature a stump names."""
    return "CASE " + column_of + " " + " ".join(f"WHEN '{c}' THEN CAST({c} AS DOUBLE)" for c in train.CUSTOMER_NUMBERS) + " END"


_STUMPS = f"""first AS ({_best("SELECT * FROM seen", train.CUSTOMER_NUMBERS, "variance")}),
told AS (SELECT s.* EXCLUDE (y), 2 * (y - CASE WHEN {_number("f.feature")} <= f.threshold THEN f.low ELSE f.high END) AS y FROM seen s, first f),
second AS ({_best("SELECT * FROM told", train.CUSTOMER_NUMBERS, "variance")})"""

FACT_ORACLES: dict[str, str] = {
    "churn_forest_facts": f"SELECT customer_id, churned AS label, TRUE AS as_nodes, TRUE AS agrees FROM {_CHURN} s WHERE is_test",
    "churn_logistic_facts": "\nUNION ALL ".join([
        _zeros("unweighted", _features(_CHURN, train.CHURN_RAW, ["plan_name"])), _zeros("balanced", _features(_CHURN, train.CHURN_RAW, ["plan_name"])),
        _zeros("balanced with engagement_rate", _CHURN_NAMES),
    ]),
    "propensity_logistic_facts": f"{_zeros('unweighted', _PEOPLE_NAMES)}\nUNION ALL {_zeros('balanced', _PEOPLE_NAMES)}",
    "ltv_linear_facts": f"""WITH seen AS (SELECT * FROM {_VALUE} s WHERE NOT is_test)
SELECT '(intercept)' AS feature, round(avg(log_ltv), 3) AS moment FROM seen
UNION ALL """
    + "\nUNION ALL ".join(f"SELECT '{c}', round(avg({c} * log_ltv), 3) FROM seen" for c in train.CUSTOMER_NUMBERS),
    "ltv_forest_facts": _ACTUAL.format("as_nodes"),
    "ltv_boosting_facts": _ACTUAL.format("as_nodes"),
    "churn_tree_root": f"SELECT {_SHOWN} FROM ({_best(_CHURN_WEIGHTED, train.CHURN_RAW, 'gini')}) b",
    "ltv_tree_root": f"SELECT {_SHOWN} FROM ({_best(_VALUE_SEEN, train.CUSTOMER_NUMBERS, 'variance')}) b",
    "churn_best_split": f"SELECT {_SHOWN} FROM ({_best(_CHURN_WEIGHTED, train.CHURN_RAW, 'gini')}) b",
    "ltv_best_split": f"SELECT {_SHOWN} FROM ({_best(_VALUE_SEEN, train.CUSTOMER_NUMBERS, 'variance')}) b",
    "boosting_two_rounds": f"""WITH seen AS ({_VALUE_SEEN}), {_STUMPS}
SELECT customer_id, round(CASE WHEN {_number("f.feature")} <= f.threshold THEN f.low ELSE f.high END
  + 0.1 * CASE WHEN {_number("g.feature")} <= g.threshold THEN g.low ELSE g.high END, 6) AS prediction
FROM {_VALUE} s, first f, second g WHERE is_test""",
    "boosted_stumps": f"""WITH seen AS ({_VALUE_SEEN}), {_STUMPS}
SELECT CAST(round AS BIGINT) AS round, feature, round(threshold, 6) AS threshold, round(low, 6) AS low, round(high, 6) AS high
FROM (SELECT 0 AS round, * FROM first UNION ALL SELECT 1, * FROM second) b""",
    "model_comparison_facts": f"""SELECT model, round(v, 2) AS variance
FROM (SELECT var_pop(total_ltv) AS v FROM {_VALUE} s WHERE is_test) w,
  (VALUES ('linear'), ('random forest'), ('gradient boosting')) AS names(model)""",
    "coefficient_ranking_facts": f"SELECT feature, CAST(0 AS DOUBLE) AS residual, TRUE AS in_order FROM ({_PEOPLE_NAMES}) n",
    "impurity_importance_facts": f"SELECT feature, TRUE AS as_nodes FROM ({_CHURN_NAMES}) n",
    "permutation_importance_facts": f"SELECT feature, TRUE AS as_table FROM ({_CHURN_NAMES}) n",
    "permutation_importance_propensity_facts": f"SELECT feature, TRUE AS as_table FROM ({_PEOPLE_NAMES}) n",
    "permutation_importance_ltv_facts": f"SELECT feature, TRUE AS as_table FROM ({_VALUE_NAMES}) n",
    "save_load_model_facts": f"SELECT count(*) AS n, CAST(0 AS BIGINT) AS differing FROM {_CHURN} s WHERE is_test",
    "score_churn_facts": f"SELECT customer_id, TRUE AS as_table FROM ({ORACLES['churn_scoring_features']}) f",
    "score_propensity_facts": f"SELECT customer_id, TRUE AS as_table FROM ({ORACLES['propensity_scoring_features']}) f",
    "score_ltv_facts": f"SELECT customer_id, TRUE AS as_table FROM ({ORACLES['propensity_scoring_features']}) f",
    "batch_score_customers_facts": f"""SELECT customer_id, c.customer_id IS NOT NULL AS has_churn, p.customer_id IS NOT NULL AS has_propensity,
  p.customer_id IS NOT NULL AS has_ltv, TRUE AS as_tables
FROM ({ORACLES['propensity_scoring_features']}) p FULL JOIN ({ORACLES['churn_scoring_features']}) c USING (customer_id)""",
}
