"""Models as tables: weights of linear models and nodes of trees, scored by joins and column functions alone.

A weight table has ``(feature, level, weight)``: the intercept, one row per number, one per level of a category.  A node table
has ``(tree, node, feature, level, threshold, left, right, value, weight)``: node 0 is the root, a value of at most
``threshold`` goes left, leaves have no feature, ``left`` -1 and a ``value``; ``weight`` is the tree's.  A feature with a
level is 1 for rows of that level and else 0.

Such tables can be kept, read, compared and scored by any engine.  ``weight_table`` and ``node_table`` write fitted models down.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.models.prepare import vector_levels
from larkspur.operators.scale import attach_small, keep, work_folder

INTERCEPT = "(intercept)"
WEIGHTS = "feature string, level string, weight double"
_PACKED = ("place", "threshold", "left", "right", "value")
NODES = "tree int, node int, feature string, level string, threshold double, left int, right int, value double, weight double"


def places(model: PipelineModel) -> list[tuple[str, str | None]]:
    """What each place of the feature vector stands for: a number, or a level of a category."""
    levels: dict[str, tuple[str, list[str]]] = {}
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            levels[vector_levels(stage)[0]] = (stage.getInputCol(), list(stage.labels))
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    out: list[tuple[str, str | None]] = []
    for column in assembler.getInputCols():
        category, found = levels.get(column, (column, None))
        out += [(category, level) for level in found] if found is not None else [(column, None)]
    return out


def weight_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """The weights of a fitted linear or logistic model."""
    fitted = model.stages[-1]
    rows = [(INTERCEPT, None, float(fitted.intercept))]
    rows += [(c, level, float(w)) for (c, level), w in zip(places(model), fitted.coefficients.toArray(), strict=True)]
    return spark.createDataFrame(rows, WEIGHTS)


def linear_margin(rows: DataFrame, weights: DataFrame, numbers: list[str], categories: list[str]) -> DataFrame:
    """``rows`` with ``margin``: the intercept and the weighted sum of numbers and levels; a level without weight adds nothing.

    Weights of numbers are one small map in the plan; those of levels, of which there may be any number, are joined.
    """
    entries = F.map_from_entries(F.collect_list(F.struct("feature", "weight")))
    known = weights.where("level IS NULL").agg(entries.alias("known")).scalar()
    of = lambda name: F.coalesce(F.element_at(known, F.lit(name)), F.lit(0.0))
    margin = of(INTERCEPT)
    for c in numbers:
        margin = margin + F.col(c).cast("double") * of(c)
    for c in categories:
        side = weights.where((F.col("feature") == c) & F.col("level").isNotNull())
        rows = attach_small(rows, side.select(F.col("level").alias(c), F.col("weight").alias(f"_{c}_weight")), [c], "left", f"weights-{c}")
        margin = margin + F.coalesce(F.col(f"_{c}_weight"), F.lit(0.0))
    return rows.withColumn("margin", margin).drop(*[f"_{c}_weight" for c in categories])


def chance(margin: Column) -> Column:
    """Probability of class 1 from the margin of a logistic model."""
    return 1 / (1 + F.exp(-margin))


def feature_values(features: list[tuple[str, str | None]]) -> Column:
    """The features of a row as an array of doubles; levels are 0 or 1."""
    one = lambda c, level: F.col(c).cast("double") if level is None else F.when(F.col(c) == level, 1.0).otherwise(0.0)
    return F.array(*[one(c, level) for c, level in features])


def _numbered_nodes(nodes: DataFrame, features: list[tuple[str, str | None]]) -> DataFrame:
    """A row per node, numbered ``at`` one tree after the other, so that children are such numbers, too; ``top`` marks roots.

    A leaf leads back to itself; ``value`` is multiplied by its tree's ``weight``.
    """
    names = F.array(*[F.lit(f"{c}={level}" if level is not None else c) for c, level in features])
    name = F.when(F.col("level").isNull(), F.col("feature")).otherwise(F.concat_ws("=", "feature", "level"))
    place = F.coalesce(F.array_position(names, name) - 1, F.lit(-1)).cast("int")
    ahead = Window.orderBy("tree").rowsBetween(Window.unboundedPreceding, -1)  # a row per tree
    trees = nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("_size"), F.first("weight").alias("_weight"))
    trees = trees.withColumn("_root", F.coalesce(F.sum("_size").over(ahead), F.lit(0)).cast("int"))
    inside = F.row_number().over(Window.partitionBy("tree").orderBy("node")) - 1
    placed = nodes.drop("weight").withColumn("_at", inside).join(F.broadcast(trees), "tree")
    at, leaf = F.col("_root") + F.col("_at"), F.col("left") < 0
    to = lambda c: F.when(leaf, at).otherwise(F.col("_root") + F.col(c)).alias(c)
    worth = (F.col("_weight") * F.col("value")).alias("value")
    found = at.alias("at"), place.alias("place"), "threshold", to("left"), to("right"), worth
    return placed.select(*found, (F.col("_at") == 0).alias("top"), F.col("_weight").alias("weight"))


def _listed(numbered: DataFrame, *more: str) -> DataFrame:
    """One row ``(n, roots, weight)``: all nodes in order, the places of the roots and the weight of all trees."""
    return numbered.agg(
        F.array_sort(F.collect_list(F.struct("at", *_PACKED, *more))).alias("n"), F.array_sort(F.collect_list(F.when(F.col("top"), F.col("at")))).alias("roots"),
        F.sum(F.when(F.col("top"), F.col("weight"))).alias("weight"),
    )


def packed_trees(nodes: DataFrame, features: list[tuple[str, str | None]]) -> Column:
    """The nodes of all trees as flat arrays, one value in the plan: ``(place, threshold, left, right, value, roots, weight)``."""
    held = _listed(_numbered_nodes(nodes, features))
    return held.select(F.struct(*[F.col(f"n.{c}").alias(c) for c in _PACKED], "roots", "weight")).scalar()


def _held(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once per row however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def tree_score(
    rows: DataFrame, nodes: DataFrame, features: list[tuple[str, str | None]], depth: int, mean: bool = True, own: Column | None = None
) -> DataFrame:
    """``rows`` with ``score``: the weighted mean over trees of the value of the leaf a row falls into, or the weighted sum.

    A row walks ``depth`` steps down each tree.  ``own`` gives the features as an array where the columns do not.  The model
    stays outside the rows: only numbers are read from it, no row carries a copy.
    """

    def total(own: Column, place: Column, threshold: Column, left: Column, right: Column, value: Column, roots: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            down = F.get(own, F.get(place, at)) <= F.get(threshold, at)
            return F.when(down, F.get(left, at)).otherwise(F.get(right, at))

        steps = F.array(*[F.lit(i) for i in range(depth)])
        leaf = lambda root: F.aggregate(steps, root, step)
        return F.aggregate(roots, F.lit(0.0), lambda sum_, root: sum_ + F.get(value, leaf(root)))

    def score(model: Column) -> Column:
        def bound(values: list[Column], left: list[Column]) -> Column:
            return _held(left[0], lambda v: bound([*values, v], left[1:])) if left else total(*values)

        summed = bound([], [feature_values(features) if own is None else own, *[model[c] for c in (*_PACKED, "roots")]])
        return summed / model["weight"] if mean else summed

    # Used once, so that Spark puts the value of the subquery where it is used and no row carries it.
    return rows.withColumn("_model", packed_trees(nodes, features)).withColumn("score", _held(F.col("_model"), score)).drop("_model")


def _boxes(numbered: DataFrame, depth: int) -> DataFrame:
    """``numbered`` with ``box``: per feature asked on the way to a leaf, the values that take the same turns, above ``low`` up to ``high``."""
    inner = numbered.where("left != at").select("at", "place", "threshold", "left", "right")
    none, threshold = F.lit(None).cast("double"), F.col("threshold")
    ways = numbered.where("top").select("at", F.array().cast("array<struct<place: int, low: double, high: double>>").alias("way"))

    def turn(to: str, low: Column, high: Column) -> Column:
        limit = F.struct("place", low.alias("low"), high.alias("high"))
        return F.struct(F.col(to).alias("at"), F.concat("way", F.array(limit)).alias("way"))

    for _ in range(depth):
        both = F.array(turn("left", none, threshold), turn("right", threshold, none))
        on = F.when(F.col("left").isNull(), F.array(F.struct("at", "way"))).otherwise(both)
        ways = ways.join(F.broadcast(inner), "at", "left").select(F.explode(on).alias("to")).select("to.*")  # a row per inner node
    of = lambda place: F.filter("way", lambda w: w["place"] == place)
    limits = lambda place: F.struct(
        place.alias("f"), F.array_max(F.transform(of(place), lambda w: w["low"])).alias("low"), F.array_min(F.transform(of(place), lambda w: w["high"])).alias("high")
    )
    boxes = ways.select("at", F.transform(F.array_distinct("way.place"), limits).alias("box"))
    return numbered.join(boxes, "at", "left")


def tree_changes(
    rows: DataFrame, nodes: DataFrame, features: list[tuple[str, str | None]], depth: int, mean: bool = True
) -> DataFrame:
    """What replacing one value of a row adds to its ``tree_score``: ``rows`` without ``own`` and ``swaps``, with ``f``, ``repeats``, ``change``.

    ``own`` has the features as an array of doubles, ``swaps`` for each of them the ``(value, repeats)`` to put in its place.  A tree that
    does not ask for the feature on the row's way down, or where the value takes the same turns, gives the row the same leaf: only
    the others are walked again, and values that change no tree have no row.  Other columns and ``repeats`` must tell rows apart.
    The steps of a walk are columns, so that Spark compiles them; each reads its numbers from the model beside the rows.
    """
    numbered = keep(_numbered_nodes(nodes, features), "numbered-nodes")
    packed = keep(_listed(_boxes(numbered, depth), "box"), "packed-trees").select(
        *[F.col(f"n.{c}").alias(c) for c in ("place", "threshold", "value", "box")], "roots", "weight",
        F.flatten(F.transform("n", lambda n: F.array(n["left"], n["right"]))).alias("children"),
    )
    of, kept = (lambda c: packed.select(c).scalar()), [F.col(c) for c in rows.columns if c not in ("own", "swaps")]

    def walked(rows: DataFrame, name: str, value: Callable[[Column], Column]) -> DataFrame:
        """``rows`` with ``name``, the place of the leaf that is reached from ``_root``."""
        at = F.col("_root")
        for i in range(depth):
            rows = rows.withColumn(f"{name}_asks_{i}", F.get(of("place"), at))
            down = value(F.col(f"{name}_asks_{i}")) <= F.get(of("threshold"), at)
            # No sum or product of whole numbers: their check for overflow takes longer than the step.
            rows = rows.withColumn(f"{name}_{i}", F.get(of("children"), F.shiftleft(at, 1).bitwiseOR(F.when(down, 0).otherwise(1))))
            at = F.col(f"{name}_{i}")
        return rows.withColumn(name, at)

    was = walked(rows.withColumn("_root", F.explode(of("roots"))), "_leaf", lambda place: F.get("own", place))
    was = was.select(*kept, "own", "swaps", "_root", F.get(of("value"), F.col("_leaf")).alias("_was"), F.explode(F.get(of("box"), F.col("_leaf"))).alias("_limit"))
    asked = was.withColumn("_swap", F.explode(F.get("swaps", F.col("_limit.f"))))
    value = F.col("_swap.value")
    asked = asked.where((value <= F.col("_limit.low")) | (value > F.col("_limit.high"))).select(
        *kept, "own", "_root", "_was", F.col("_limit.f").alias("f"), value.alias("_value"), F.col("_swap.repeats").alias("repeats")
    )
    new = walked(asked, "_new", lambda place: F.when(place == F.col("f"), F.col("_value")).otherwise(F.get("own", place)))
    change = F.sum(F.get(of("value"), F.col("_new")) - F.col("_was"))
    return new.groupBy(*kept, "f", "repeats").agg((change / of("weight") if mean else change).alias("change"))


def score_equations(
    rows: DataFrame, weights: DataFrame, numbers: list[str], categories: list[str], label: str, weight: str | None = None,
    penalty: float = 1.0,
) -> DataFrame:
    """``(feature, level, residual)``: how far each weight of a logistic model is from solving its score equation.

    At the optimum the weighted sum of (label - probability) times a feature equals ``penalty`` times its weight, and zero for the
    intercept.  Residuals are shares of the weighted sum of the feature's size.  One row per weight, all from one pass.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    scored = linear_margin(rows, weights, numbers, categories)
    off = w * (F.col(label).cast("double") - chance(F.col("margin")))
    none = F.lit(None).cast("string")
    terms = [F.struct(F.lit(INTERCEPT).alias("feature"), none.alias("level"), F.lit(1.0).alias("x"))]
    terms += [F.struct(F.lit(c).alias("feature"), none.alias("level"), F.col(c).cast("double").alias("x")) for c in numbers]
    terms += [F.struct(F.lit(c).alias("feature"), F.col(c).alias("level"), F.lit(1.0).alias("x")) for c in categories]
    long = scored.select(off.alias("off"), w.alias("w"), F.explode(F.array(*terms)).alias("t")).select("off", "w", "t.*")
    sums = long.groupBy(F.col("feature").alias("f"), F.col("level").alias("l")).agg(
        F.sum(F.col("off") * F.col("x")).alias("s"), F.sum(F.col("w") * F.abs("x")).alias("size")
    )
    joined = weights.join(sums, F.col("feature").eqNullSafe(F.col("f")) & F.col("level").eqNullSafe(F.col("l")), "left")
    pull = F.when(F.col("feature") == INTERCEPT, 0.0).otherwise(penalty * F.col("weight"))
    residual = F.abs(F.coalesce("s", F.lit(0.0)) - pull) / F.greatest(F.coalesce("size", F.lit(1.0)), F.lit(1.0))
    return joined.select("feature", "level", residual.alias("residual"))


def node_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """The nodes of a fitted forest or boosted model, with ``gain``, ``n`` (summed row weights) and, per leaf, its value.

    Read from the model as Spark ML saves it.  A leaf's value is its prediction, for classes the share of class 1.
    """
    fitted = model.stages[-1]
    folder = f"{work_folder(spark)}/nodes-{uuid.uuid4().hex}"
    fitted.write().save(folder)
    saved = spark.read.parquet(f"{folder}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    found = spark.createDataFrame([(i, c, level) for i, (c, level) in enumerate(places(model))], "at int, feature string, level string")
    trees = spark.createDataFrame([(i, float(w)) for i, w in enumerate(fitted.treeWeights)], "tree int, weight double")
    stats = F.col("impurityStats")
    classes = hasattr(fitted, "numClasses")
    n = F.aggregate(stats, F.lit(0.0), lambda a, b: a + b) if classes else F.get(stats, F.lit(0))
    value = F.get(stats, F.lit(1)) / n if classes else F.col("prediction")
    inner = F.col("leftChild") >= 0
    # A level's 0/1 may be split as a category, with the values that go left: as a threshold 0 goes left, so sides may swap.
    first = F.get(F.col("split.leftCategoriesOrThreshold"), F.lit(0))
    category = F.col("split.numCategories") >= 0
    swap = inner & category & (first == 1.0)
    threshold = F.when(inner, F.when(category, 0.5).otherwise(first))
    read = saved.select(
        "tree", F.col("id").alias("node"), F.when(inner, F.col("split.featureIndex")).alias("at"), threshold.alias("threshold"),
        F.when(swap, F.col("rightChild")).otherwise(F.col("leftChild")).alias("left"),
        F.when(swap, F.col("leftChild")).otherwise(F.col("rightChild")).alias("right"), value.alias("value"),
        F.when(inner, F.col("gain")).otherwise(0.0).alias("gain"), n.alias("n"),
    )
    named = read.join(F.broadcast(found), "at", "left").join(F.broadcast(trees), "tree")  # a row per place, a row per tree
    return named.select("tree", "node", "feature", "level", "threshold", "left", "right", "value", "weight", "gain", "n")


def importance_from_nodes(nodes: DataFrame) -> DataFrame:
    """``(feature, level, value)``: gain times rows of the splits on each feature, as a share per tree, averaged and scaled to one."""
    split = nodes.where("left >= 0").withColumn("worth", F.col("gain") * F.col("n"))
    trees = split.groupBy("tree").agg(F.sum("worth").alias("of_tree"))
    per_tree = split.groupBy("tree", "feature", "level").agg(F.sum("worth").alias("worth")).join(trees, "tree")
    summed = per_tree.where("of_tree > 0").groupBy("feature", "level").agg(F.sum(F.col("worth") / F.col("of_tree")).alias("share"))
    whole = summed.agg(F.sum("share")).scalar()
    return summed.select("feature", "level", (F.col("share") / whole).alias("value"))


