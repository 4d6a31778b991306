"""Models and explanations on planted data, where the right answer is known."""

import itertools
import math
import re
from dataclasses import replace
from datetime import date, datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from larkspur.models import evaluate, explain, prepare, score, splits, tabular, train
from larkspur.models.train import Study
from larkspur.operators.ids import hold_out

TODAY = date(2026, 8, 15)


def _noise(*salt):
    return (F.pmod(F.xxhash64("id", *[F.lit(s) for s in salt]), F.lit(1000)) / 1000).cast("double")


@pytest.fixture(scope="module")
def planted(spark):
    """Label 1 when x1 > 0.8 (a fifth of the rows); x2 is constant; x3 and the category say nothing."""
    rows = spark.range(1200).select(
        F.col("id").alias("customer_id"),
        _noise("x1").alias("x1"),
        F.lit(3.0).alias("x2"),
        _noise("x3").alias("x3"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("kind"),
    )
    labelled = rows.withColumn("y", (F.col("x1") > 0.8).cast("int")).withColumn("v", F.col("x1") * 10)
    return hold_out(labelled, "customer_id").cache()


@pytest.fixture(scope="module")
def study(planted):
    return Study(planted, "customer_id", "y", ("x1", "x2", "x3"), ("kind",))


@pytest.fixture(scope="module")
def forest(study):
    return train.forest_classifier(study, trees=10, depth=4)


def _scores(frame):
    return {r["feature"]: r for r in frame.collect()}


def test_permutation_importance_finds_the_planted_feature(study, forest):
    found = _scores(explain.permutation_importance(forest, study.test, "customer_id", "y", "recall", repeats=4))
    assert found["x1"]["rank"] == 1 and found["x1"]["importance_mean"] > 0.5
    assert found["x2"]["importance_mean"] == 0.0 and found["x2"]["importance_std"] == 0.0
    assert set(found) == {"x1", "x2", "x3", "kind_b"}


def test_permutation_importance_equals_brute_force(study, forest):
    """The same shuffles, each feature swapped and all rows scored again, on the driver."""
    repeats, names = 3, train.feature_names(forest)
    head, fitted = forest.stages[:-1], forest.stages[-1]
    rows = study.test
    for stage in head:
        rows = stage.transform(rows)
    from larkspur.operators.ids import assign_ids

    local = assign_ids(rows.select("customer_id", "y", "features"), "customer_id", "i", start=0).orderBy("i").collect()
    n = len(local)
    vectors, labels = [list(r.features.toArray()) for r in local], [r.y for r in local]

    def recall(xs):
        from pyspark.ml.linalg import Vectors

        hits = [fitted.predict(Vectors.dense(x)) == 1 for x, y in zip(xs, labels, strict=True) if y == 1]
        return sum(hits) / len(hits)

    base = recall(vectors)
    want = {}
    for f, name in enumerate(names):
        drops = []
        for a, b in explain._affine_steps(n, repeats, 42):
            moved = [[*x[:f], vectors[(i * a + b) % n][f], *x[f + 1 :]] for i, x in enumerate(vectors)]
            drops.append(base - recall(moved))
        want[name] = sum(drops) / repeats
    found = _scores(explain.permutation_importance(forest, study.test, "customer_id", "y", "recall", repeats=repeats))
    assert {k: r["importance_mean"] for k, r in found.items()} == pytest.approx(want)


def test_permutation_importance_of_a_regression(planted):
    study = Study(planted, "customer_id", "v", ("x1", "x2", "x3"), ())
    model = train.linear(study)
    found = _scores(explain.permutation_importance(model, study.test, "customer_id", "v", "r2", repeats=4))
    assert found["x1"]["rank"] == 1 and 1.0 < found["x1"]["importance_mean"] < 3.0
    assert found["x2"]["importance_mean"] == 0.0


def test_affine_steps_are_permutations():
    for n in (1, 2, 9, 100):
        for a, b in explain._affine_steps(n, 5, 1):
            assert sorted((i * a + b) % n for i in range(n)) == list(range(n))


def test_partial_dependence_rises_where_the_label_does(forest, study):
    curve = [(r.grid_value, r.avg_prediction) for r in explain.partial_dependence(forest, study.train, "x1", 20).collect()]
    assert len(curve) == 20 and curve == sorted(curve)
    assert max(p for x, p in curve if x < 0.7) < min(p for x, p in curve if x > 0.85)
    constant = explain.partial_dependence(forest, study.train, "x2").collect()
    assert [r.grid_value for r in constant] == [3.0]


def test_partial_dependence_equals_brute_force(forest, study):
    value = explain.feature_grid(study.train, "x1", 20)[4]
    moved = forest.transform(study.train.withColumn("x1", F.lit(value)))
    want = moved.agg(F.avg(vector_to_array("probability")[1])).first()[0]
    got = {r.grid_value: r.avg_prediction for r in explain.partial_dependence(forest, study.train, "x1", 20).collect()}
    assert got[value] == pytest.approx(want)


def test_impurity_and_coefficients_rank_the_planted_feature(spark, forest, study):
    impurity = _scores(explain.impurity_importance(spark, forest))
    assert impurity["x1"]["rank"] == 1 and impurity["x2"]["value"] == 0.0
    ranked = explain.coefficient_ranking(spark, train.logistic(study)).collect()
    assert ranked[0].feature == "x1" and [r.value for r in ranked] == sorted((r.value for r in ranked), reverse=True)


def _recall(model, study):
    lines = evaluate.classification_report(train.predict_class(model, study.test, study.label)).collect()
    return {r["class"]: r.recall for r in lines}["1"]


def test_balanced_weights_raise_recall(planted):
    blurred = planted.withColumn("y", ((F.col("x1") + F.col("x3")) > 1.5).cast("int"))
    study = Study(blurred.drop("x3"), "customer_id", "y", ("x1", "x2"), ("kind",))
    assert _recall(train.logistic(study, balanced=True), study) > _recall(train.logistic(study), study)


def test_logistic_penalty(spark):
    """One feature, two rows of each kind: the optimum of sum of log-losses + b^2 / 2 solves an equation in b."""
    import math

    rows = spark.createDataFrame([(i, float(x), y, False) for i, (x, y) in enumerate([(1, 1), (1, 1), (-1, 0), (-1, 0)])],
                                 "customer_id long, x double, y int, is_test boolean")
    model = train.logistic(Study(rows, "customer_id", "y", ("x",), ()))
    b = model.stages[-1].coefficients[0]
    assert b == pytest.approx(4 / (1 + math.exp(b)), abs=1e-3)


def test_saved_model_predicts_the_same(spark, forest, study, tmp_path):
    train.save_model(forest, str(tmp_path / "model"))
    again = train.load_model(str(tmp_path / "model"))
    assert train.feature_names(again) == ["x1", "x2", "x3", "kind_b"]
    before = train.predict_class(forest, study.test).orderBy("customer_id").collect()
    assert train.predict_class(again, study.test).orderBy("customer_id").collect() == before


def test_unseen_and_quoted_levels(spark):
    rows = spark.createDataFrame([(1, "it's"), (2, "back\\slash"), (3, "a")], "customer_id long, kind string")
    encoder = prepare.Encoder.fit(rows, ["kind"])
    assert encoder.names == ["kind_back\\slash", "kind_it's"]
    new = spark.createDataFrame([(1, "it's"), (2, "new"), (3, None), (4, "back\\slash")], rows.schema)
    want = [(0, 1), (0, 0), (0, 0), (1, 0)]
    encoded = encoder.apply(new).orderBy("customer_id")
    assert [tuple(r) for r in encoded.select(*[f"`{c}`" for c in encoder.names]).collect()] == want
    staged = Pipeline(stages=[*encoder.stages(), prepare.assembler([], encoder)]).fit(rows).transform(new).orderBy("customer_id")
    assert [tuple(r.features.toArray()) for r in staged.select("features").collect()] == want
    aligned = prepare.align_features(encoder.apply(new), ["kind_it's", "kind_other", "customer_id"])
    assert [tuple(r) for r in aligned.orderBy("customer_id").collect()] == [(1, 0, 1), (0, 0, 2), (0, 0, 3), (0, 0, 4)]


def test_many_levels_fit_and_score(spark):
    levels = [F.concat(F.lit(c), (F.col("customer_id") * k % 400).cast("string")).alias(c) for c, k in (("a", 1), ("b", 3), ("c", 7))]
    rows = spark.range(1, 1201).withColumnRenamed("id", "customer_id").select(
        "customer_id", (F.col("customer_id") % 400).cast("double").alias("v"), (F.col("customer_id") % 5 == 0).alias("is_test"), *levels
    )
    study = Study(rows, "customer_id", "v", (), ("a", "b", "c"))
    model = train.linear(study)
    known = {c: {r[c] for r in study.train.select(c).distinct().collect()} for c in ("a", "b", "c")}
    assert len(train.feature_names(model)) == sum(len(v) - 1 for v in known.values()) > 900
    assert model.transform(study.test).count() == 240


def test_one_level_is_no_feature(spark):
    rows = spark.createDataFrame([(i, "x", float(i), False) for i in range(8)], "customer_id long, kind string, v double, is_test boolean")
    model = train.linear(Study(rows.withColumn("w", F.col("v") * 2), "customer_id", "w", ("v",), ("kind",)))
    assert train.feature_names(model) == ["v"]


def test_models_do_not_depend_on_how_rows_arrive(forest, planted):
    """The same rows in another number of partitions, in another order: the same trees."""
    moved = Study(planted.repartition(7).sortWithinPartitions(F.desc("x1")), "customer_id", "y", ("x1", "x2", "x3"), ("kind",))
    few = Study(planted.coalesce(1), "customer_id", "y", ("x1", "x2", "x3"), ("kind",))
    scores = [
        [tuple(r) for r in train.predict_class(train.forest_classifier(s, 8, 4), planted).orderBy("customer_id").collect()]
        for s in (moved, few)
    ]
    assert scores[0] == scores[1]


def test_class_weights_balance(spark):
    rows = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    assert {r.y: r.weight for r in prepare.class_weights(rows, "y").collect()} == {0: 8 / 12, 1: 2.0}


def test_reports_of_known_predictions(spark):
    cells = [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4
    frame = spark.createDataFrame(cells, "label int, prediction int")
    assert [tuple(r) for r in evaluate.confusion_matrix(frame).collect()] == [(0, 0, 4), (0, 1, 2), (1, 0, 1), (1, 1, 3)]
    lines = {r["class"]: r for r in evaluate.classification_report(frame).collect()}
    assert lines["1"].precision == pytest.approx(0.6) and lines["1"].recall == pytest.approx(0.75)
    assert lines["accuracy"].f1 == pytest.approx(0.7) and lines["0"].support == 6
    assert lines["weighted avg"].recall == pytest.approx(0.7)
    pairs = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 2.0)], "actual double, predicted double")
    line = evaluate.regression_report(pairs).first()
    assert (line.rmse, line.mae, line.r2) == pytest.approx(((10 / 3) ** 0.5, 4 / 3, 1 - 10 / 8))


def test_bias_per_tenth(spark):
    frame = spark.range(100).select(F.col("id").cast("double").alias("actual"), F.lit(50.0).alias("predicted"))
    tenths = evaluate.actual_vs_predicted(frame).collect()
    assert [(r.decile, r.n) for r in tenths] == [(i, 10) for i in range(1, 11)]
    assert tenths[0].bias == pytest.approx(45.5) and tenths[9].avg_actual == pytest.approx(94.5)


def test_boosting_and_comparison(planted):
    study = Study(planted, "customer_id", "v", ("x1", "x2", "x3"), ())
    models = {"boosting": train.boosting(study, rounds=5, depth=2), "forest": train.forest_regressor(study, 10, 4),
              "linear": train.linear(study)}
    predictions = {
        name: m.transform(study.test).select(F.col("v").alias("actual"), F.col("prediction").alias("predicted"))
        for name, m in models.items()
    }
    ranked = evaluate.model_comparison(predictions).collect()
    assert [r.rmse for r in ranked] == sorted(r.rmse for r in ranked) and ranked[0].model == "linear"


@pytest.fixture(scope="module")
def business(make):
    people, subs, events, orders = [], [], [], []
    for i in range(300):
        joined = TODAY - timedelta(days=30 + (i * 37) % 600)
        kind = ("saas", "ecommerce", "both")[i % 3]
        people.append({"customer_id": i, "signup_date": joined, "acquisition_channel": ("Google", "Meta")[i % 2],
                       "country": ("India", "Canada")[i % 5 == 0], "customer_type": kind})
        if kind != "ecommerce":
            gone = (i * 37) % 600 < 250
            subs.append({"subscription_id": i, "customer_id": i, "plan_name": "Basic", "start_date": joined, "mrr": D("15"),
                         "end_date": joined + timedelta(days=20) if gone else None, "status": "cancelled" if gone else "active"})
        for k in range(i % 7):
            events.append({"event_id": i * 10 + k, "customer_id": i, "event_date": TODAY, "session_id": f"{i}-{k}",
                           "event_name": ("page_view", "view_item")[k % 2], "device_category": "mobile"})
        if i % 7 > 3:
            orders.append({"order_id": i, "customer_id": i, "order_date": TODAY, "total_amount": D("40.00"), "order_status": "completed"})
    return make(customers=people, subscriptions=subs, ga4_events=events, orders=orders)


def test_scoring_job(spark, business, tmp_path):
    churn = train.forest_classifier(train.churn_study(business, TODAY), trees=5, depth=3)
    propensity = train.logistic(train.propensity_study(business, TODAY), balanced=True)
    ltv = train.forest_regressor(train.ltv_study(business, TODAY), trees=5, depth=3)
    paths = [str(tmp_path / name) for name in ("churn", "propensity", "ltv")]
    for model, path in zip((churn, propensity, ltv), paths, strict=True):
        train.save_model(model, path)
    stamp = datetime(2026, 8, 15, 3, 0)
    score.batch_score_customers(*paths, business, TODAY, stamp, "scored", str(tmp_path / "scores"))
    stored = {r.customer_id: r for r in spark.table("scored").collect()}
    active = {r.customer_id for r in business.subscriptions.where("status = 'active'").collect()}
    assert len(stored) == 300
    assert {i for i, r in stored.items() if r.churn_risk_score is not None} == active
    assert all(r.scored_at == stamp and r.predicted_ltv >= 0 for r in stored.values())
    buyers = [r.purchase_propensity_score for i, r in stored.items() if i % 7 > 3]
    others = [r.purchase_propensity_score for i, r in stored.items() if i % 7 <= 3]
    assert min(buyers) > max(others)
    assert "engagement_rate" in train.feature_names(train.load_model(paths[0]))


# --- models as tables ---------------------------------------------------------------------------------------------


def _close(joined, a, b):
    return joined.agg(F.max(F.abs(F.col(a) - F.col(b)))).first()[0] < 1e-9


def test_tables_score_as_the_models_do(spark, study, forest, planted):
    nodes, features = tabular.node_table(spark, forest), tabular.places(forest)
    told = train.predict_class(forest, study.test, "y").select("customer_id", "probability")
    assert _close(tabular.tree_score(study.test, nodes, features, 4).join(told, "customer_id"), "score", "probability")
    logistic = train.logistic(study, balanced=True)
    told = train.predict_class(logistic, study.test).select("customer_id", "probability")
    margin = tabular.linear_margin(study.test, tabular.weight_table(spark, logistic), list(study.numeric), ["kind"])
    assert _close(margin.withColumn("p", tabular.chance(F.col("margin"))).join(told, "customer_id"), "p", "probability")
    values = Study(planted, "customer_id", "v", ("x1", "x3"), ("kind",))
    boosted = train.boosting(values, rounds=5, depth=3)
    told = boosted.transform(values.test).select("customer_id", "prediction")
    scored = tabular.tree_score(values.test, tabular.node_table(spark, boosted), tabular.places(boosted), 3, mean=False)
    assert _close(scored.join(told, "customer_id"), "score", "prediction")


def test_a_value_forest_is_the_same_whatever_its_groups(planted, monkeypatch):
    values, found = Study(planted, "customer_id", "v", ("x1", "x3"), ("kind",)), []
    for memory in (train.CACHED_MB, 1, train.STATISTICS_MB):
        monkeypatch.setattr(train, "CACHED_MB", memory)
        model = train.forest_regressor(values, trees=40, depth=6)
        assert model.stages[-1].getMaxMemoryInMB() == memory
        found.append([r[0] for r in model.transform(values.test).orderBy("customer_id").select("prediction").collect()])
    assert found[0] == pytest.approx(found[1], rel=1e-9) and found[0] == pytest.approx(found[2], rel=1e-9)


def test_a_churn_forest_does_not_walk_rows_down_again(study):
    model = train.forest_classifier(study, trees=10, depth=6).stages[-1]
    assert model.getCacheNodeIds()
    plain = train.RandomForestClassifier(numTrees=10, maxDepth=6, seed=train.SEED, maxMemoryInMB=train.STATISTICS_MB)
    again = train.fit(study, plain, balanced=True).stages[-1]
    assert not again.getCacheNodeIds()
    assert model.toDebugString.split("\n")[1:] == again.toDebugString.split("\n")[1:]


def test_rows_do_not_carry_the_trees(spark, study, forest):
    nodes, features = tabular.node_table(spark, forest), tabular.places(forest)
    scored = tabular.tree_score(study.test, nodes, features, 4).select("customer_id", "score")
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "_model" not in plan and "_trees" not in plan


def test_rows_to_score_are_dealt_to_all_tasks(spark, study, forest):
    rule = score.node_rule(tabular.node_table(spark, forest), tabular.places(forest), 4)
    assert "RoundRobinPartitioning" in rule(study.test.coalesce(1))._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("metric", ["recall", "r2"])
def test_importance_scores_a_borrowed_value_once(planted, metric, monkeypatch):
    monkeypatch.setattr(explain, "TASK_PAIRS", 100, raising=False)
    rows, seen = planted.where("is_test").select("customer_id", F.round("x1", 1).alias("x1"), "kind", "y"), []
    fixed = explain.linear_judge({("x1", None): 1.0, ("kind", "b"): 0.1}, -0.5, classes=metric == "recall")

    def decide(vectors):
        seen.append(vectors)
        return fixed.decide(vectors)

    explain.permutation_importance(explain.Judge(fixed.names, fixed.encode, decide), rows, "customer_id", "y", metric, repeats=50)
    counted = rows.where("y = 1").count() if metric == "recall" else rows.count()
    vectors = seen[-1].cache()
    assert 0 < vectors.count() <= counted * (10 + 1)  # ten other values of x1, one other of the kind
    assert vectors.where("y = 0").count() == 0 or metric == "r2"
    assert seen[-1].rdd.getNumPartitions() == -(-rows.count() * 50 // 100)


def test_importance_deals_the_rows_it_scores_first(planted):
    rows, seen = planted.where("is_test").select("customer_id", "x1", "y").coalesce(1), []
    fixed = explain.linear_judge({("x1", None): 1.0}, -0.5)
    judge = replace(fixed, decide=lambda vectors: seen.append(vectors) or fixed.decide(vectors))
    explain.permutation_importance(judge, rows, "customer_id", "y", "recall", repeats=2)
    assert "RoundRobinPartitioning" in seen[0]._jdf.queryExecution().executedPlan().toString()


def test_importance_by_nodes_walks_only_trees_that_a_value_changes(spark, planted):
    values = Study(planted, "customer_id", "v", ("x1", "x2", "x3"), ("kind",))
    model, seen = train.forest_regressor(values, trees=12, depth=5), []
    judge = explain.tree_judge(tabular.node_table(spark, model), tabular.places(model), 5, classes=False)
    counting = replace(judge, decide=lambda vectors: seen.append(vectors) or judge.decide(vectors))
    by = _scores(explain.permutation_importance(counting, values.test, "customer_id", "v", "r2", repeats=6))
    told = _scores(explain.permutation_importance(model, values.test, "customer_id", "v", "r2", repeats=6))
    for column in ("importance_mean", "importance_std"):
        assert {k: r[column] for k, r in by.items()} == pytest.approx({k: r[column] for k, r in told.items()}, abs=1e-12)
    assert by["x1"]["importance_mean"] > 1 and by["x3"]["importance_mean"] != 0
    assert sum(vectors.count() for vectors in seen) == values.test.count()  # whole vectors are the rows' own


@pytest.mark.parametrize("mean", [True, False])
def test_changes_of_trees_equal_whole_scores(spark, mean):
    """One feature asked several times on a way, values on a threshold, infinite, NaN and null, unequal trees, a tree of one leaf."""
    nodes = [
        (0, 0, "a", None, 2.0, 1, 2, None, 1.0), (0, 1, "a", None, 0.0, 3, 4, None, 1.0), (0, 2, "b", None, 1.0, 5, 6, None, 1.0),
        (0, 3, None, None, None, -1, -1, 0.3, 1.0), (0, 4, "k", "x", 0.5, 7, 8, None, 1.0), (0, 5, "a", None, 3.0, 9, 10, None, 1.0),
        (0, 6, None, None, None, -1, -1, -4.7, 1.0), (0, 7, None, None, None, -1, -1, 5.1, 1.0), (0, 8, None, None, None, -1, -1, 6.9, 1.0),
        (0, 9, None, None, None, -1, -1, 0.3, 1.0), (0, 10, None, None, None, -1, -1, 8.2, 1.0),
        (3, 0, None, None, None, -1, -1, 11.0, 0.25),
        (4, 0, "b", None, 0.0, 1, 2, None, 0.5), (4, 1, None, None, None, -1, -1, 1.9, 0.5), (4, 2, "a", None, 1.0, 3, 4, None, 0.5),
        (4, 3, None, None, None, -1, -1, -2.3, 0.5), (4, 4, None, None, None, -1, -1, 0.7, 0.5),
    ]
    table, features = spark.createDataFrame(nodes, tabular.NODES), [("a", None), ("b", None), ("k", "x")]
    numbers = [-1.0, 0.0, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0, 4.0, math.inf, -math.inf, math.nan]
    own = [list(v) for v in itertools.product([*numbers, None], [-0.5, 0.0, 1.0, 7.0, None], [0.0, 1.0])]
    values = (numbers, [-3.0, 0.0, 0.5, 1.0, 2.0], [0.0, 1.0])
    rows = [(i, 1.5, v, [[(x, [p]) for p, x in enumerate(of) if v[f] is not None] for f, of in enumerate(values)]) for i, v in enumerate(own)]
    frame = spark.createDataFrame(rows, "i int, base double, own array<double>, swaps array<array<struct<value: double, repeats: array<int>>>>")
    found = tabular.tree_changes(frame, table, features, 4, mean).collect()
    assert found[0].asDict().keys() == {"i", "base", "f", "repeats", "change"}
    swapped = [(i, f, p, [*v[:f], x, *v[f + 1 :]]) for i, v in enumerate(own) for f, of in enumerate(values) for p, x in enumerate(of) if v[f] is not None]
    whole = [(i, -1, -1, v) for i, v in enumerate(own)] + swapped
    vectors = spark.createDataFrame(whole, "i int, f int, p int, own array<double>")
    scored = tabular.tree_score(vectors, table, features, 4, mean, F.col("own")).collect()
    score_of = {(r.i, r.f, r.p): r.score for r in scored}
    got = {(r.i, r.f, r.repeats[0]): r.change for r in found}
    assert len(got) == len(found) < len(swapped)
    for i, f, p, _ in swapped:
        assert got.get((i, f, p), 0.0) == pytest.approx(score_of[i, f, p] - score_of[i, -1, -1], abs=1e-12)


def test_a_zero_of_either_sign_is_borrowed_as_one_value(spark):
    lent = [(0, [0.0, 2.0]), (1, [-0.0, 1.0]), (2, [3.0, None]), (3, [3.0, math.nan])]
    frame = spark.createDataFrame([([1.0, 1.0], lent), ([-0.0, None], lent)], "own array<double>, lent array<struct<repeat: int, lent: array<double>>>")
    found = [[[(v.value, list(v.repeats)) for v in of] for of in r.swaps] for r in frame.select(explain._swaps(2).alias("swaps")).collect()]
    assert found[0][0] == [(0.0, [0, 1]), (3.0, [2, 3])] and found[0][1][0] == (2.0, [0]) and found[0][1][1][1] == [3]
    assert found[1] == [[(3.0, [2, 3])], []]


def test_importance_from_nodes(spark, forest):
    by_nodes = {(r.feature, r.level): r.value for r in tabular.importance_from_nodes(tabular.node_table(spark, forest)).collect()}
    told = dict(zip(tabular.places(forest), forest.stages[-1].featureImportances.toArray().tolist(), strict=True))
    assert {k: v for k, v in told.items() if v} == pytest.approx(by_nodes)


@pytest.mark.parametrize("balanced", [False, True])
def test_score_equations_hold_for_the_fit_and_for_no_other(spark, study, balanced):
    rows = prepare.with_class_weights(study.train, "y") if balanced else study.train
    weights = tabular.weight_table(spark, train.logistic(study, balanced))

    def residuals(table):
        found = tabular.score_equations(rows, table, list(study.numeric), ["kind"], "y", "weight" if balanced else None)
        return {(r.feature, r.level): r.residual for r in found.collect()}

    fitted = residuals(weights)
    assert set(fitted) == {(tabular.INTERCEPT, None), ("x1", None), ("x2", None), ("x3", None), ("kind", "b")}
    assert max(fitted.values()) < 5e-4
    for feature in ("x1", "x3", "kind", tabular.INTERCEPT):
        moved = weights.withColumn("weight", F.col("weight") + F.when(F.col("feature") == feature, 0.2).otherwise(0.0))
        assert max(residuals(moved).values()) > 1e-3, feature


def test_levels_of_any_number_are_joined_not_planned(spark):
    rows = spark.range(2_000).select("id", F.concat(F.lit("level "), "id").alias("c"), F.lit(2.0).alias("x"))
    weights = spark.range(1_500).select(F.lit("c").alias("feature"), F.concat(F.lit("level "), "id").alias("level"), F.col("id").cast("double").alias("weight"))
    weights = weights.union(spark.createDataFrame([(tabular.INTERCEPT, None, 1.0), ("x", None, 3.0)], tabular.WEIGHTS))
    scored = tabular.linear_margin(rows, weights, ["x"], ["c"])
    assert {r.id: r.margin for r in scored.collect()} == {i: 7.0 + (i if i < 1_500 else 0) for i in range(2_000)}


def _plain_best(rows, names, kind, weights=None):
    """Every threshold of every feature tried on all rows."""
    best = None
    for f, name in enumerate(names):
        for low, high in itertools.pairwise(sorted({x[f] for x, _ in rows})):
            sides = [[(y, w) for (x, y), w in zip(rows, weights or [1.0] * len(rows), strict=True) if (x[f] <= (low + high) / 2) == left] for left in (True, False)]
            both = sides[0] + sides[1]

            def impurity(part):
                n = sum(w for _, w in part)
                mean = sum(w * y for y, w in part) / n
                return n, (2 * mean * (1 - mean) if kind == "gini" else sum(w * (y - mean) ** 2 for y, w in part) / n)

            (n, whole), (a, left), (b, right) = impurity(both), impurity(sides[0]), impurity(sides[1])
            gain = whole - (a * left + b * right) / n
            if best is None or gain > best[2] + 1e-12:
                best = (name, (low + high) / 2, gain)
    return best


@pytest.mark.parametrize("kind", ["gini", "variance"])
def test_best_split_equals_trying_all_and_the_root_of_a_tree(spark, kind):
    rows = spark.range(300).select(
        F.col("id").alias("customer_id"), F.floor(_noise("a") * 7).alias("a"), F.floor(_noise("b") * 20).alias("b"), F.lit(1).alias("same"),
        F.lit(False).alias("is_test"),
    )
    rows = rows.withColumn("y", F.when(F.col("b") + F.col("a") * 2 > 14, 1).otherwise(F.col("customer_id") % 2).cast("int"))
    label = "y" if kind == "gini" else "v"
    rows = rows.withColumn("v", F.col("b") * F.col("b") + F.col("y") * 30.0).cache()
    study = Study(rows, "customer_id", label, ("a", "b", "same"), ())
    weighted = prepare.with_class_weights(rows, "y") if kind == "gini" else rows.withColumn("weight", F.lit(1.0))
    local = weighted.select("a", "b", "same", label, "weight").collect()
    want = _plain_best([((r.a, r.b, r.same), r[label]) for r in local], ["a", "b", "same"], kind, [r.weight for r in local])
    found = splits.best_split(weighted, ["a", "b", "same"], label, kind, "weight").first()
    root = tabular.node_table(spark, train.whole_tree(study, 1, classes=kind == "gini")).where("node = 0").first()
    assert (found.feature, found.threshold) == (root.feature, root.threshold) == want[:2]
    assert found.gain == pytest.approx(want[2]) == pytest.approx(root.gain)
    assert splits.best_split(rows, ["same"], label, kind).count() == 0


def test_stumps_equal_boosting(spark, planted):
    rows = planted.withColumn("a", F.floor(F.col("x1") * 40)).withColumn("b", F.floor(F.col("x3") * 30)).withColumn("t", F.col("a") * F.col("a") + F.col("b"))
    study = Study(rows, "customer_id", "t", ("a", "b"), ())
    model = train.boosting(study, rounds=3, depth=1, bins=train.EXACT_BINS)
    found = splits.boosted_stumps(study.train, ["a", "b"], "t", rounds=3).collect()
    nodes = {(r.tree, r.node): r for r in tabular.node_table(spark, model).collect()}
    for r in found:
        root = nodes[r["round"], 0]
        assert (r.feature, r.threshold, r.weight) == (root.feature, root.threshold, root.weight)
        assert (nodes[r["round"], root.left].value, nodes[r["round"], root.right].value) == pytest.approx((r.low, r.high))


def test_training_partitions_follow_the_rows(planted):
    study = Study(planted, "customer_id", "y", ("x1",), ())
    assert train.training_parts(study) == train.LEAST_PARTS
    assert train.training_parts(replace(study, parts=3)) == 3
    big = Study(planted.sparkSession.range(40_000_000).select(F.lit(False).alias("is_test")), "customer_id", "y", (), ())
    assert train.training_parts(big) == 40


def test_dependence_of_few_vectors_scores_few(spark, study):
    """Rows that agree in the other features meet the grid once, whatever their number."""
    rows = spark.range(5_000).select((F.col("id") % 3).cast("double").alias("a"), (F.col("id") % 2).cast("double").alias("b"))
    seen = []
    fixed = explain.linear_judge({("a", None): 1.0, ("b", None): -0.5}, -0.25)

    def counting(vectors):
        seen.append(vectors.count())
        return fixed.decide(vectors)

    found = explain.partial_dependence(explain.Judge(fixed.names, fixed.encode, counting), rows, "a").collect()
    assert seen == [3 * 2]
    chance = lambda m: 1 / (1 + math.exp(-m))
    want = {v: (chance(v - 0.25) + chance(v - 0.75)) / 2 for v in (0.0, 1.0, 2.0)}
    assert {r.grid_value: r.avg_prediction for r in found} == pytest.approx(want)


def test_many_levels_are_indexed_in_spark(spark):
    """100,000 levels: the plan is as long as for three, and vectors are sparse."""
    def plan(n):
        rows = spark.range(n + 7).select("id", F.format_string("level %06d", F.col("id") % n).alias("c"), F.lit(2.5).alias("x"))
        made = prepare.LevelIndex.fit(rows.union(spark.createDataFrame([(-1, None, 1.0)], "id bigint, c string, x double")), ["c"]).vectors(rows, ["x"])
        return made, len(re.sub(r"#\d+L?|\d+", "", made._jdf.queryExecution().optimizedPlan().toString()))

    few, short = plan(3)
    many, long = plan(100_000)
    assert long < short * 1.5
    vectors = {r.id: r.features for r in many.where("id IN (0, 1, 99999, 100003)").collect()}
    assert all(v.size == 100_000 for v in vectors.values())
    assert {i: dict(zip(v.indices.tolist(), v.values.tolist(), strict=True)) for i, v in vectors.items()} == {
        0: {0: 2.5}, 1: {0: 2.5, 1: 1.0}, 99_999: {0: 2.5, 99_999: 1.0}, 100_003: {0: 2.5, 3: 1.0}
    }
    none = prepare.one_hot_sparse(spark.createDataFrame([(1, None)], "id int, c string"), ["c"]).collect()
    assert [r.places for r in none] == [[]]
