"""What drives a model: coefficients, impurity importance, permutation importance, partial dependence."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial
from math import gcd

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.models.tabular import chance, feature_values, tree_changes, tree_score
from larkspur.models.train import feature_names
from larkspur.operators.ids import assign_ids
from larkspur.operators.scale import dealt, keep


# Multipliers of the steps of a shuffle, the fractional digits of two irrational numbers.
STEP, OFFSET = 618_033_989, 414_213_562
TASK_PAIRS = 5_000  # pairs of a row and a repeat that one task scores again, feature by feature


@dataclass(frozen=True)
class Judge:
    """What explanations need of a model, fitted or fixed: names of features, rows to vectors, vectors to predictions."""

    names: list[str]
    encode: Callable[[DataFrame], DataFrame]  # adds ``own``, the features as an array of doubles
    decide: Callable[[DataFrame], DataFrame]  # from ``own``, adds ``prediction`` and, for classes, ``chance`` of class 1
    # From rows with ``own``, ``base`` and ``swaps``, the latter per feature a list of ``(value, repeats)``: ``f``, ``repeats`` and the new
    # ``prediction`` where it changes.  Without it every swapped vector is decided.
    decide_swaps: Callable[[DataFrame], DataFrame] | None = None


def judge_of(model: PipelineModel | Judge) -> Judge:
    """A fitted pipeline as a judge: its last stage decides, the others encode."""
    if isinstance(model, Judge):
        return model
    fitted, head = model.stages[-1], PipelineModel(model.stages[:-1])

    def encode(rows: DataFrame) -> DataFrame:
        return head.transform(rows).withColumn("own", vector_to_array("features"))

    def decide(vectors: DataFrame) -> DataFrame:
        scored = fitted.transform(vectors.drop("features").withColumn("features", array_to_vector("own")))
        chance = {"chance": vector_to_array("probability")[1]} if "probability" in scored.columns else {}
        return scored.select(*vectors.columns, "prediction", *[c.alias(n) for n, c in chance.items()])

    return Judge(feature_names(model), encode, decide)


def linear_judge(weights: dict[tuple[str, str | None], float], intercept: float, classes: bool = True) -> Judge:
    """A fixed linear rule: class 1 where the weighted sum is positive, or the sum itself as the prediction."""
    features, values = list(weights), F.array(*[F.lit(float(w)) for w in weights.values()])

    def decide(vectors: DataFrame) -> DataFrame:
        terms = F.zip_with("own", values, lambda x, w: x * w)
        margin = F.aggregate(terms, F.lit(float(intercept)), lambda a, b: a + b)
        if not classes:
            return vectors.withColumn("prediction", margin)
        return vectors.withColumns({"prediction": (margin > 0).cast("double"), "chance": chance(margin)})

    names = [c if level is None else f"{c}_{level}" for c, level in features]
    return Judge(names, lambda rows: rows.withColumn("own", feature_values(features)), decide)


def tree_judge(nodes: DataFrame, features: list[tuple[str, str | None]], depth: int, classes: bool = True, mean: bool = True) -> Judge:
    """A model kept as a table of nodes."""

    def decide(vectors: DataFrame) -> DataFrame:
        scored = tree_score(vectors, nodes, features, depth, mean, F.col("own"))
        if not classes:
            return scored.withColumnRenamed("score", "prediction")
        return scored.withColumn("prediction", (F.col("score") > 0.5).cast("double")).withColumnRenamed("score", "chance")

    def decide_swaps(asked: DataFrame) -> DataFrame:
        return tree_changes(asked, nodes, features, depth, mean).withColumn("prediction", F.col("base") + F.col("change"))

    names = [c if level is None else f"{c}_{level}" for c, level in features]
    # A sum of changes may end on the other side of one half, so classes are decided from whole vectors.
    return Judge(names, lambda rows: rows.withColumn("own", feature_values(features)), decide, None if classes else decide_swaps)


def _ranked(spark, names: list[str], values: list[float]) -> DataFrame:
    """A fitted model's own numbers, one per feature, largest first."""
    pairs = sorted(zip(names, map(float, values), strict=True), key=lambda p: (-p[1], p[0]))
    rows = [(name, value, rank) for rank, (name, value) in enumerate(pairs, start=1)]
    return spark.createDataFrame(rows, "feature string, value double, rank int")


def coefficient_ranking(spark, model: PipelineModel) -> DataFrame:
    return _ranked(spark, feature_names(model), list(model.stages[-1].coefficients.toArray()))


def impurity_importance(spark, model: PipelineModel) -> DataFrame:
    return _ranked(spark, feature_names(model), list(model.stages[-1].featureImportances.toArray()))


def _affine_steps(n: int, repeats: int, seed: int) -> list[tuple[int, int]]:
    """``repeats`` one-to-one maps i -> (a i + b) mod n of the row numbers 0 .. n-1, by plain arithmetic that SQL can repeat."""
    n, steps = max(n, 1), []
    for r in range(1, repeats + 1):
        a = 1 + (r * STEP + seed) % n
        while gcd(a, n) > 1:
            a += 1
        steps.append((a, (r * OFFSET + seed) % n))
    return steps


def permutation_importance(
    model: PipelineModel | Judge, rows: DataFrame, key: str, label: str, metric: str, repeats: int = 10, seed: int = 42
) -> DataFrame:
    """Mean drop of ``metric`` ('recall' of class 1, or 'r2') when one feature is shuffled among the rows.

    Rows are numbered by their unique ``key``; in each repeat row i borrows from row (a i + b) mod n, a one-to-one map, so every column keeps
    its values.  One join brings each (row, repeat) the whole donor vector, and features are swapped in locally: the
    shuffle grows with rows x repeats, not with the number of features.  A row whose own value equals the borrowed one
    keeps its prediction and is not scored again, which is most rows of a rare 0/1 column and all of a constant one; nor is
    one of class 0 for recall.  A row that borrows the same value in several repeats is scored once.  Scoring is dealt
    to tasks by the number of pairs, as their bytes say little about its work.
    """
    judge = judge_of(model)
    names = judge.names
    vectors = judge.encode(dealt(rows)).select(key, "own", F.col(label).cast("double").alias("y"))
    based = judge.decide(vectors).select(key, "own", "y", F.col("prediction").alias("base"))
    numbered = keep(assign_ids(based, key, "i", start=0), "permutation-rows")
    n = numbered.count()
    steps = F.array(
        *[
            F.struct(F.lit(r).alias("repeat"), F.lit(a).cast("decimal(20,0)").alias("a"), F.lit(b).alias("b"))
            for r, (a, b) in enumerate(_affine_steps(n, repeats, seed))
        ]
    )
    step, parts = F.col("step"), max(1, -(-n * repeats // TASK_PAIRS))
    donor = ((F.col("i") * step["a"] + step["b"]) % F.lit(max(n, 1))).cast("bigint")
    counted = numbered.where("y = 1") if metric == "recall" else numbered  # recall looks at no other rows
    asking = counted.select("i", "own", "y", "base", F.explode(steps).alias("step")).select(
        "i", "own", "y", "base", step["repeat"].alias("repeat"), donor.alias("donor")
    )
    donors = numbered.select(F.col("i").alias("donor"), F.col("own").alias("lent"))
    pairs = asking.join(donors, "donor").repartition(parts, "i")  # all repeats of a row in one task
    lent = F.collect_list(F.struct("repeat", "lent")).alias("lent")
    rowwise = pairs.groupBy("i").agg(*[F.first(c).alias(c) for c in ("own", "y", "base")], lent)
    asked = rowwise.select("i", "y", "base", "own", _swaps(len(names)).alias("swaps"))
    rescored = (judge.decide_swaps or partial(_decide_swaps, judge))(asked).withColumn("repeat", F.explode("repeats"))
    new, old, y = F.col("prediction"), F.col("base"), F.col("y")
    if metric == "recall":
        hits, asked = F.count_if((y == 1) & (old == 1)), F.count_if(y == 1)
        whole = numbered.agg(hits.cast("double").alias("score"), asked.cast("double").alias("scale"))
        change = F.when(y == 1, (new == 1).cast("double") - (old == 1).cast("double")).otherwise(0.0)
        drop = -F.col("change") / F.nullif("scale", F.lit(0.0))
    elif metric == "r2":
        whole = numbered.agg((F.var_pop("y") * F.count(F.lit(1))).alias("scale"))
        change = (y - new) * (y - new) - (y - old) * (y - old)
        drop = F.col("change") / F.nullif("scale", F.lit(0.0))
    else:
        raise ValueError(f"unknown metric {metric}")
    changes = rescored.groupBy("f", "repeat").agg(F.sum(change).alias("change"))
    spark = rows.sparkSession
    every = spark.createDataFrame(
        [(f, name, r) for f, name in enumerate(names) for r in range(repeats)], "f int, feature string, repeat int"
    )
    scale = whole.select("scale").first()[0]
    complete = every.join(changes, ["f", "repeat"], "left").select(
        "feature", F.coalesce("change", F.lit(0.0)).alias("change"), F.lit(scale).alias("scale")
    )
    summed = complete.groupBy("feature").agg(
        F.avg(drop).alias("importance_mean"), F.stddev_pop(drop).alias("importance_std")
    )
    place = F.row_number().over(Window.orderBy(F.desc("importance_mean"), "feature"))  # one row per feature
    return summed.withColumn("rank", place).orderBy("rank")


def _swaps(features: int) -> Column:
    """Per feature the other values that a row borrows, each with the repeats it borrows it in."""

    def of(f: Column) -> Column:
        value = lambda pair: F.get(pair["lent"], f) + 0.0  # noqa: E731  # one zero, not two of either sign
        differing = F.filter("lent", lambda pair: F.get("own", f) != value(pair))
        repeats = lambda v: F.transform(F.filter("lent", lambda pair: value(pair) == v), lambda pair: pair["repeat"])
        values = F.array_distinct(F.transform(differing, value))
        return F.transform(values, lambda v: F.struct(v.alias("value"), repeats(v).alias("repeats")))

    return F.transform(F.sequence(F.lit(0), F.lit(features - 1)), of)


def _decide_swaps(judge: Judge, asked: DataFrame) -> DataFrame:
    """Every swapped vector, decided."""
    listed = asked.select("y", "base", "own", F.posexplode("swaps").alias("f", "of")).withColumn("swap", F.explode("of"))
    return judge.decide(listed.select("y", "base", "f", "swap.repeats", "swap.value", "own").select("y", "base", "repeats", "f", _swap().alias("own")))


def _swap() -> Column:
    """The own vector with the borrowed value at position ``f``."""
    return F.transform("own", lambda value, at: F.when(at == F.col("f"), F.col("value")).otherwise(value))


def feature_grid(rows: DataFrame, feature: str, size: int = 100) -> list[float]:
    """At most ``size`` values of a feature: all of them when few, else evenly spaced from the 5th to the 95th
    percentile."""
    value = F.col(feature).cast("double")
    few = rows.select(value.alias("v")).where(F.col("v").isNotNull()).distinct().limit(size + 1).collect()
    if len(few) <= size:
        return sorted(r["v"] for r in few)
    low, high = rows.agg(F.percentile_approx(value, [0.05, 0.95], 10_000)).first()[0]
    return [low + (high - low) * k / (size - 1) for k in range(size)]


def partial_dependence(model: PipelineModel | Judge, rows: DataFrame, feature: str, size: int = 100) -> DataFrame:
    """Mean probability of class 1 with ``feature`` set to each grid value for every row.

    Rows that agree in all other features are one vector with a count: only distinct vectors meet the grid, which is at most
    ``size`` numbers in the plan, and only averages move after that.
    """
    grid, judge = feature_grid(rows, feature, size), judge_of(model)
    at = judge.names.index(feature)
    others = F.transform("own", lambda value, i: F.when(i == at, F.lit(0.0)).otherwise(value))
    vectors = judge.encode(rows).groupBy(others.alias("own")).agg(F.count(F.lit(1)).alias("n"))
    repeated = vectors.select("own", "n", F.explode(F.array(*[F.lit(v) for v in grid])).alias("grid_value"))
    moved = F.transform("own", lambda value, i: F.when(i == at, F.col("grid_value")).otherwise(value))
    scored = judge.decide(repeated.select("grid_value", "n", moved.alias("own")))
    mean = F.sum(F.col("chance") * F.col("n")) / F.sum("n")
    averages = scored.groupBy("grid_value").agg(mean.alias("avg_prediction"))
    return averages.select(F.lit(feature).alias("feature"), "grid_value", "avg_prediction").orderBy("grid_value")
