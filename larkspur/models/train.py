"""Churn, propensity and customer-value models with Spark ML."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.models.prepare import Encoder, assembler, vector_levels, with_class_weights
from larkspur.operators.ids import hold_out, stratified_hold_out
from larkspur.operators.scale import keep, work_folder
from larkspur.plans.features import churn_features, log_target, ltv_features, propensity_features
from larkspur.sources.tables import Tables

# Model settings.
SEED, TEST_SHARE = 42, 0.2
TREES, TREE_DEPTH = 200, 8
BOOST_ROUNDS, BOOST_DEPTH, BOOST_STEP = 200, 4, 0.1
LOGISTIC_ITERATIONS = 1000
BINS, EXACT_BINS = 32, 4096  # values of a feature between which trees look for splits; the larger one for exact trees
# Not a model setting: memory a task may use for split statistics.  The default of 256 MB needs several passes over
# the rows per tree level for 200 trees.
STATISTICS_MB = 512
# Where every split looks at every feature the trees do not depend on which nodes are worked on together, so that statistics may
# stay small enough for a processor's cache: more passes over the rows, each much faster.
CACHED_MB = 48
# Training rows are dealt into one partition per so many rows, and some at least.  Model settings too, since sampling is
# seeded per partition: trees depend on the number of rows, and on nothing a cluster has.
PART_ROWS, LEAST_PARTS = 1_000_000, 8

_MESSAGE_NUMBERS = ["crm_emails_sent", "crm_emails_opened", "crm_emails_clicked"]
CHURN_RAW = ["tenure_months", "mrr", "total_events", "active_days", *_MESSAGE_NUMBERS, "also_ecommerce"]
CHURN_RATE = ["tenure_months", "mrr", "total_events", *_MESSAGE_NUMBERS, "also_ecommerce", "engagement_rate"]
CUSTOMER_NUMBERS = [
    "account_age_months",
    "page_views",
    "view_item_events",
    "distinct_sessions",
    "mobile_session_pct",
    *_MESSAGE_NUMBERS,
]
CUSTOMER_CATEGORIES = ["acquisition_channel", "country", "customer_type"]


@dataclass(frozen=True)
class Study:
    """A feature table, written once and split, with what is to be predicted from what."""

    rows: DataFrame
    key: str
    label: str
    numeric: tuple[str, ...]
    categories: tuple[str, ...]
    parts: int | None = None  # of the training rows; from their number unless given

    @property
    def train(self) -> DataFrame:
        return self.rows.where(~F.col("is_test"))

    @property
    def test(self) -> DataFrame:
        return self.rows.where("is_test")


def _study(split: DataFrame, key: str, label: str, numeric: list[str], categories: list[str], parts: int | None) -> Study:
    # Training reads the rows many times; as a table they are joined and aggregated once.
    return Study(keep(split, f"study-{label}"), key, label, tuple(numeric), tuple(categories), parts)


def churn_study(t: Tables, as_of: date, parts: int | None = None) -> Study:
    """Class shares are the same in both parts; several subscriptions of one customer stay on one side."""
    features = churn_features(t, as_of, keep_id=True)
    split = stratified_hold_out(features, "customer_id", "churned", SEED, TEST_SHARE)
    return _study(split, "subscription_id", "churned", CHURN_RATE, ["plan_name"], parts)


def with_numbers(study: Study, numeric: list[str]) -> Study:
    """The same rows and split, predicted from other numbers."""
    return replace(study, numeric=tuple(numeric))


def propensity_study(t: Tables, as_of: date, parts: int | None = None) -> Study:
    split = stratified_hold_out(propensity_features(t, as_of), "customer_id", "purchased", SEED, TEST_SHARE)
    return _study(split, "customer_id", "purchased", CUSTOMER_NUMBERS, CUSTOMER_CATEGORIES, parts)


def ltv_study(t: Tables, as_of: date, parts: int | None = None) -> Study:
    features = log_target(ltv_features(t, as_of)).drop("back")
    split = hold_out(features, "customer_id", SEED, TEST_SHARE)
    return _study(split, "customer_id", "log_ltv", CUSTOMER_NUMBERS, CUSTOMER_CATEGORIES, parts)


def training_parts(study: Study) -> int:
    """Partitions of the training rows: a function of their number alone."""
    return study.parts or max(LEAST_PARTS, -(-study.train.count() // PART_ROWS))


def fit(study: Study, estimator: Estimator, balanced: bool = False) -> PipelineModel:
    """Fit encoder, assembler and estimator on the training part.

    The encoder's levels come from the training rows; the fitted pipeline carries them, so a saved model needs no
    separate list of features.  Rows reach the estimator in partitions by their unique key, each in key order, and as many as
    the number of rows asks for, so the same rows give the same model on any cluster.
    """
    rows = with_class_weights(study.train, study.label) if balanced else study.train
    if balanced:
        estimator = estimator.copy({estimator.weightCol: "weight"})
    encoder = Encoder.fit(study.train, list(study.categories))
    stages = [*encoder.stages(), assembler(list(study.numeric), encoder)]
    rows = rows.repartition(training_parts(study), study.key).sortWithinPartitions(study.key)
    return Pipeline(stages=[*stages, estimator.copy({estimator.labelCol: study.label})]).fit(rows)


def feature_names(model: PipelineModel) -> list[str]:
    """One name per place of the feature vector: numbers, then the levels of each category."""
    levels = dict(vector_levels(stage) for stage in model.stages if isinstance(stage, StringIndexerModel))
    return [name for column in model.stages[-2].getInputCols() for name in levels.get(column, [column])]


def logistic(study: Study, balanced: bool = False) -> PipelineModel:
    """L2-regularised logistic regression: one half of the squared coefficients against the summed losses.

    Spark averages losses over the total weight instead, which equals the row count with and without balanced weights;
    hence the penalty of one over the row count.
    """
    penalty = 1.0 / max(study.train.count(), 1)
    estimator = LogisticRegression(maxIter=LOGISTIC_ITERATIONS, regParam=penalty, standardization=False)
    return fit(study, estimator, balanced)


def forest_classifier(study: Study, trees: int = TREES, depth: int = TREE_DEPTH) -> PipelineModel:
    """Rows remember the node they have reached in each tree, so that a level does not walk them down from the roots again; the
    trees are the same.  That takes four bytes per row and tree, on disk where memory is short."""
    estimator = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=SEED, maxMemoryInMB=STATISTICS_MB, cacheNodeIds=True
    )
    return fit(study, estimator, balanced=True)


def whole_tree(study: Study, depth: int, classes: bool = True) -> PipelineModel:
    """One tree that sees all rows, all features and, up to ``EXACT_BINS`` values of a feature, every split."""
    kind = RandomForestClassifier if classes else RandomForestRegressor
    settings = {"numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all", "maxBins": EXACT_BINS}
    return fit(study, kind(maxDepth=depth, seed=SEED, maxMemoryInMB=STATISTICS_MB, **settings), balanced=classes)


def linear(study: Study) -> PipelineModel:
    return fit(study, LinearRegression(regParam=0.0))


def forest_regressor(study: Study, trees: int = TREES, depth: int = TREE_DEPTH) -> PipelineModel:
    """Every split may look at every feature."""
    estimator = RandomForestRegressor(
        numTrees=trees, maxDepth=depth, seed=SEED, featureSubsetStrategy="all", maxMemoryInMB=CACHED_MB
    )
    return fit(study, estimator)


def boosting(study: Study, rounds: int = BOOST_ROUNDS, depth: int = BOOST_DEPTH, bins: int = BINS) -> PipelineModel:
    """Each round builds on the residuals of all before it; Spark cuts that lineage every ten rounds, given a folder
    for checkpoints."""
    context = study.rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_folder(study.rows.sparkSession))
    return fit(study, GBTRegressor(maxIter=rounds, maxDepth=depth, stepSize=BOOST_STEP, seed=SEED, maxBins=bins))


def predict_class(model: PipelineModel, rows: DataFrame, label: str | None = None) -> DataFrame:
    """``customer_id``, label if any, 0/1 prediction and probability of class 1."""
    scored = model.transform(rows).withColumn("p1", vector_to_array("probability")[1])
    kept = ["customer_id"] + ([F.col(label).alias("label")] if label else [])
    return scored.select(*kept, F.col("prediction").cast("int").alias("prediction"), F.col("p1").alias("probability"))


def predict_value(model: PipelineModel, rows: DataFrame, actual: str | None = None) -> DataFrame:
    """``customer_id``, actual value if any, and the predicted value taken back from log scale."""
    scored = model.transform(rows)
    kept = ["customer_id"] + ([F.col(actual).cast("double").alias("actual")] if actual else [])
    return scored.select(*kept, F.expm1("prediction").alias("predicted"))


def save_model(model: PipelineModel, path: str) -> None:
    """Encoder, feature order and fitted model together."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
