"""Every operator as a query over the order-star files in a folder: name -> function of (spark, folder).

Results carry plain types (bigint, double), as SQL engines agree on those.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FloatType, IntegerType, ShortType

from larkspur.fixed_models import FIXED_ORACLES, FIXED_QUERIES
from larkspur.model_facts import FACT_ORACLES, fact_queries
from larkspur.models import evaluate, explain, score, tabular, train
from larkspur.models.prepare import align_features, class_weights, one_hot_drop_first, one_hot_sparse
from larkspur.operators import aggregates, experiment, filters, ids, joins, quality, windows
from larkspur.operators.scale import keep, work_folder
from larkspur.oracles import BUYER_COUNTRY, MIN_ORDERS, ORACLES, REPORT_YEAR
from larkspur.plans import exports, features, metrics, reports
from larkspur.sources import sinks
from larkspur.sources.schemas import PRIMARY_KEYS, SCHEMAS, VOCABULARY
from larkspur.sources.star import AS_OF, star_tables
from larkspur.sources.tables import Tables, read_table

Query = Callable[[SparkSession, str], DataFrame]
SCORED_AT = datetime(2001, 12, 31)


def plain(rows: DataFrame) -> DataFrame:
    """Decimals as double, small integers as bigint."""
    def shown(field):
        kind = field.dataType
        if isinstance(kind, (DecimalType, FloatType)):
            return F.col(f"`{field.name}`").cast("double").alias(field.name)
        if isinstance(kind, (IntegerType, ShortType)):
            return F.col(f"`{field.name}`").cast("bigint").alias(field.name)
        return F.col(f"`{field.name}`")

    return rows.select(*[shown(f) for f in rows.schema.fields])


def rounded(rows: DataFrame, **places: int) -> DataFrame:
    return rows.withColumns({c: F.round(F.col(c).cast("double"), p) for c, p in places.items()})


# --- queries that need a little more than one call ---------------------------------------------------------------


def _combine_scores(t: Tables) -> DataFrame:
    def part(column: str) -> DataFrame:
        return t.customer_scores.where(F.col(column).isNotNull()).select("customer_id", column)

    parts = [part(c) for c in ("churn_risk_score", "purchase_propensity_score", "predicted_ltv")]
    return joins.combine_scores(*parts, SCORED_AT)


def _target_summary(t: Tables) -> DataFrame:
    summary = aggregates.target_summary(metrics.customer_value(t, AS_OF), "total_ltv")
    return rounded(summary, mean=4, std=4, p25=4, p50=4, p75=4)


def _split_churn(t: Tables) -> DataFrame:
    return ids.stratified_hold_out(features.churn_features(t, AS_OF), "customer_id", "churned")


def _one_hot(t: Tables) -> DataFrame:
    columns = ["acquisition_channel", "country", "customer_type"]
    return one_hot_drop_first(t.customers.select("customer_id", *columns), columns)


def _one_hot_sparse(t: Tables) -> DataFrame:
    columns = ["acquisition_channel", "country", "customer_type"]
    found = one_hot_sparse(t.customers.select("customer_id", *columns), columns)
    return found.select("customer_id", F.array_join(F.col("places").cast("array<string>"), ",").alias("places"))


def _align(t: Tables) -> DataFrame:
    encoded = one_hot_drop_first(t.customers.select("customer_id", "customer_type"), ["customer_type"])
    expected = ["customer_id", "customer_type_saas", "customer_type_reseller", "customer_type_ecommerce"]
    return align_features(encoded, expected)


def _guesses(t: Tables) -> DataFrame:
    """Label: has a completed order.  Prediction: stored propensity of at least one half."""
    flagged = joins.buyers(t).withColumn("label", F.lit(1))
    joined = t.customer_scores.join(flagged, "customer_id", "left")
    said = F.when(F.col("purchase_propensity_score") >= 0.5, 1).otherwise(0)
    return joined.select(F.coalesce("label", F.lit(0)).alias("label"), said.alias("prediction"))


def _fixed_values(t: Tables) -> DataFrame:
    actual = metrics.customer_value(t, AS_OF).select("customer_id", F.col("total_ltv").alias("actual"))
    return actual.join(t.customer_scores.select("customer_id", F.col("predicted_ltv").alias("predicted")), "customer_id")


def _quality_keys(t: Tables) -> DataFrame:
    return quality.report(*[quality.primary_key(getattr(t, name), name, key) for name, key in PRIMARY_KEYS.items()])


def _quality_parents(t: Tables) -> DataFrame:
    children = ("ga4_events", "orders", "subscriptions", "crm_engagement", "ab_test_assignments", "customer_scores")
    return quality.report(*[quality.foreign_key(getattr(t, c), t.customers, c) for c in children])


def _quality_filled(t: Tables) -> DataFrame:
    required = {name: [f.name for f in schema if not f.nullable] for name, schema in SCHEMAS.items()}
    return quality.report(*[quality.not_null(getattr(t, name), name, columns) for name, columns in required.items()])


def _quality_domains(t: Tables) -> DataFrame:
    per_table: dict[str, dict[str, tuple]] = {}
    for (table, column), values in VOCABULARY.items():
        per_table.setdefault(table, {})[column] = values
    return quality.report(*[quality.domain(getattr(t, name), name, allowed) for name, allowed in per_table.items()])


def _quality_totals(t: Tables) -> DataFrame:
    """Unit prices derived from the totals, in whole cents rounded down, so that some totals do not divide."""
    price = F.floor(F.col("total_amount") * 100 / F.col("quantity")) / 100
    return quality.order_total(t.orders.withColumn("unit_price", price.cast("decimal(12,2)")))


def _quality_sources(t: Tables) -> DataFrame:
    """Traffic sources derived from the device."""
    device = F.col("device_category")
    source = F.when(device == "desktop", "google").when(device == "mobile", "meta").otherwise("organic")
    return quality.source_matches_channel(t.ga4_events.withColumn("traffic_source", source), t.customers)


def _ab_every_year(t: Tables) -> DataFrame:
    return reports.report_ab_every_year(aggregates.customer_growth(t), aggregates.ab_conversion_by_year(t))


# --- writing whole tables to the shared folder and reading them back ---------------------------------------------


def _place(rows: DataFrame, label: str) -> str:
    return f"{work_folder(rows.sparkSession)}/{label}-{uuid.uuid4().hex}"


def _csv_and_back(t: Tables) -> DataFrame:
    folder = _place(t.customers, "csv")
    sinks.write_csv(t.customers, folder)
    return read_table(t.customers.sparkSession, "customers", folder, "csv")


def _json_and_back(t: Tables) -> DataFrame:
    folder = _place(t.customers, "json")
    sinks.write_json({"customers": t.customers}, folder)
    return read_table(t.customers.sparkSession, "customers", f"{folder}/customers", "json")


def _fields(records: DataFrame) -> DataFrame:
    """Every value of ``records(dataset, place, record)``, a record being a map of text: numbers as numbers, the rest as text."""
    values = records.select("dataset", F.col("place").cast("bigint").alias("place"), F.explode("record").alias("field", "shown"))
    number = F.col("shown").try_cast("double")
    return values.select("dataset", "place", "field", number.alias("number"), F.when(number.isNull(), F.col("shown")).alias("words"))


def _document_and_back(t: Tables) -> DataFrame:
    """Every value of the exported JSON document."""
    path = f"{_place(t.customers, 'document')}.json"
    exports.export_bundle(t, AS_OF, path)
    text = t.customers.sparkSession.read.text(path, wholetext=True)  # one file, parsed as one document
    sections = F.from_json("value", "map<string, array<map<string, string>>>")
    listed = text.select(F.explode(sections).alias("dataset", "records"))
    return _fields(listed.select("dataset", F.posexplode("records").alias("place", "record")).withColumn("place", F.col("place") + 1))


def _csvs_and_back(t: Tables) -> DataFrame:
    """Every value of the exported CSV files."""
    spark, folder = t.customers.sparkSession, _place(t.customers, "csvs")
    names = exports.export_csvs(t, AS_OF, folder)

    def read(name: str) -> DataFrame:
        rows = spark.read.option("header", True).csv(f"{folder}/{name}")
        record = F.create_map(*[x for c in rows.columns for x in (F.lit(c), F.col(c))])
        placed = Window.orderBy(F.monotonically_increasing_id())  # a report of a few rows in one file
        return rows.select(F.lit(name).alias("dataset"), F.row_number().over(placed).alias("place"), record.alias("record"))

    return _fields(reduce(DataFrame.unionByName, map(read, names)))


def _append_and_back(t: Tables) -> DataFrame:
    """The customers in two batches."""
    folder = _place(t.customers, "append")
    shop = F.col("customer_type") == "ecommerce"
    sinks.bulk_append(t.customers.where(shop), folder)
    sinks.bulk_append(t.customers.where(~shop), folder)
    return read_table(t.customers.sparkSession, "customers", folder)


def _load_twice(t: Tables) -> DataFrame:
    """A first load and a second one, which must be refused."""
    folder = _place(t.customers, "load")
    sinks.load_once(t.customers, folder)
    try:
        sinks.load_once(t.customers, folder)
    except ValueError:
        return read_table(t.customers.sparkSession, "customers", folder)
    raise AssertionError("the second load was not refused")


def _refreshed(t: Tables) -> str:
    """Name of a score table that was loaded in part and then replaced as a whole."""
    name, folder = f"larkspur_scores_{uuid.uuid4().hex}", _place(t.customer_scores, "refresh")
    sinks.full_refresh(t.customer_scores.where(F.col("churn_risk_score").isNotNull()), name, folder)
    sinks.full_refresh(t.customer_scores, name, folder)
    return name


def _refresh_and_back(t: Tables) -> DataFrame:
    return t.customer_scores.sparkSession.table(_refreshed(t)).drop("scored_at")


def _truncate_and_back(t: Tables) -> DataFrame:
    spark, name = t.customer_scores.sparkSession, _refreshed(t)
    sinks.truncate_reset(spark, name, _place(t.customer_scores, "truncate"))
    return filters.row_count(spark.table(name))


def _save_and_back(m: Lab) -> DataFrame:
    """Held-out predictions of a model that was saved and loaded again."""
    folder = f"{work_folder(m.churn().rows.sparkSession)}/model-{uuid.uuid4().hex}"
    train.save_model(m.churn_forest(), folder)
    return train.predict_class(train.load_model(folder), m.churn().test, "churned")


# --- models: trained once per folder and session, used by several queries ----------------------------------------


class Lab:
    """Studies and fitted models of one folder, each built on first use."""

    def __init__(self, t: Tables):
        self.t = t
        self.churn = cache(lambda: train.churn_study(t, AS_OF))
        self.churn_raw = cache(lambda: train.with_numbers(self.churn(), train.CHURN_RAW))
        self.propensity = cache(lambda: train.propensity_study(t, AS_OF))
        self.ltv = cache(lambda: train.ltv_study(t, AS_OF))
        self.churn_forest = cache(lambda: train.forest_classifier(self.churn()))
        self.propensity_balanced = cache(lambda: train.logistic(self.propensity(), balanced=True))
        self.ltv_forest = cache(lambda: train.forest_regressor(self.ltv()))
        self.ltv_linear = cache(lambda: train.linear(self.ltv()))
        self.ltv_boosting = cache(lambda: train.boosting(self.ltv()))
        spark = t.customers.sparkSession
        self.churn_nodes = cache(lambda: keep(tabular.node_table(spark, self.churn_forest()), "churn-nodes"))
        self.ltv_nodes = cache(lambda: keep(tabular.node_table(spark, self.ltv_forest()), "ltv-nodes"))
        self.boosting_nodes = cache(lambda: keep(tabular.node_table(spark, self.ltv_boosting()), "boosting-nodes"))

    def churn_logistic(self) -> DataFrame:
        """Held-out reports of the three logistic variants."""
        raw, rate = self.churn_raw(), self.churn()
        fitted = {
            "unweighted": (train.logistic(raw), raw),
            "balanced": (train.logistic(raw, balanced=True), raw),
            "balanced with engagement_rate": (train.logistic(rate, balanced=True), rate),
        }
        return _labelled_reports({name: train.predict_class(m, s.test, s.label) for name, (m, s) in fitted.items()})

    def propensity_logistic(self) -> DataFrame:
        s = self.propensity()
        fitted = {"unweighted": train.logistic(s), "balanced": self.propensity_balanced()}
        return _labelled_reports({name: train.predict_class(m, s.test, s.label) for name, m in fitted.items()})

    def value_predictions(self, model) -> DataFrame:
        return train.predict_value(model, self.ltv().test, "total_ltv")

    def comparison(self) -> DataFrame:
        models = {
            "linear": self.ltv_linear(),
            "random forest": self.ltv_forest(),
            "gradient boosting": self.ltv_boosting(),
        }
        return evaluate.model_comparison({name: self.value_predictions(m) for name, m in models.items()})

    def importance(self, which: str) -> DataFrame:
        model, s, metric = {
            "churn": (self.churn_forest, self.churn, "recall"),
            "propensity": (self.propensity_balanced, self.propensity, "recall"),
            "ltv": (self.ltv_forest, self.ltv, "r2"),
        }[which]
        study = s()
        return explain.permutation_importance(model(), study.test, study.key, study.label, metric)

    def dependence(self) -> DataFrame:
        parts = [
            explain.partial_dependence(self.churn_forest(), self.churn().train, feature)
            for feature in ("tenure_months", "engagement_rate")
        ]
        return parts[0].unionByName(parts[1])

    def scores(self) -> DataFrame:
        return score.score_customers(
            self.churn_forest(), self.propensity_balanced(), self.ltv_forest(), self.t, AS_OF, SCORED_AT
        )


def _labelled_reports(predictions: dict[str, DataFrame]) -> DataFrame:
    reports_ = [
        evaluate.classification_report(rows).select(F.lit(name).alias("model"), "*") for name, rows in predictions.items()
    ]
    return quality.report(*reports_)


_open: dict[tuple[str, str], Tables] = {}
_labs: dict[tuple[str, str], Lab] = {}


def tables(spark: SparkSession, folder: str) -> Tables:
    """The tables of a folder, opened once per application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _open:
        _open[key] = star_tables(spark, folder)
    return _open[key]


def lab(spark: SparkSession, folder: str) -> Lab:
    """The models of a folder live as long as the application: one training serves all queries about a model."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _labs:
        _labs[key] = Lab(tables(spark, folder))
    return _labs[key]


MODEL_QUERIES: dict[str, Callable[[SparkSession, Lab], DataFrame]] = {
    "churn_logistic": lambda spark, m: m.churn_logistic(),
    "churn_forest": lambda spark, m: train.predict_class(m.churn_forest(), m.churn().test, "churned"),
    "propensity_logistic": lambda spark, m: m.propensity_logistic(),
    "ltv_linear": lambda spark, m: m.value_predictions(m.ltv_linear()),
    "ltv_forest": lambda spark, m: m.value_predictions(m.ltv_forest()),
    "ltv_boosting": lambda spark, m: m.value_predictions(m.ltv_boosting()),
    "model_comparison": lambda spark, m: m.comparison(),
    "coefficient_ranking": lambda spark, m: explain.coefficient_ranking(spark, m.propensity_balanced()),
    "impurity_importance": lambda spark, m: explain.impurity_importance(spark, m.churn_forest()),
    "permutation_importance": lambda spark, m: m.importance("churn"),
    "permutation_importance_propensity": lambda spark, m: m.importance("propensity"),
    "permutation_importance_ltv": lambda spark, m: m.importance("ltv"),
    "partial_dependence": lambda spark, m: m.dependence(),
    "save_load_model": lambda spark, m: _save_and_back(m),
    "score_churn": lambda spark, m: score.score_churn(m.churn_forest(), m.t, AS_OF),
    "score_propensity": lambda spark, m: score.score_propensity(
        m.propensity_balanced(), features.propensity_scoring_features(m.t, AS_OF)
    ),
    "score_ltv": lambda spark, m: score.score_ltv(m.ltv_forest(), features.propensity_scoring_features(m.t, AS_OF)),
    "batch_score_customers": lambda spark, m: m.scores(),
    "actual_vs_predicted": lambda spark, m: evaluate.actual_vs_predicted(m.value_predictions(m.ltv_forest())),
}

TABLE_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    # sources
    "src_table": lambda t: t.customers,
    "row_count": lambda t: filters.row_count(t.customers),
    "preview": lambda t: filters.preview(t.customers, "customer_id"),
    "full_table": lambda t: filters.preview(t.orders, "order_id", None),
    "assign_ids": lambda t: ids.assign_ids(t.ga4_events.select("event_id"), "event_id"),
    "sink_csv": _csv_and_back,
    "sink_json": _json_and_back,
    "sink_json_bundle": _document_and_back,
    "bulk_append": _append_and_back,
    "load_once_guard": _load_twice,
    "full_refresh": _refresh_and_back,
    "truncate_reset": _truncate_and_back,
    # filters
    "recent_completed_orders": filters.recent_completed_orders,
    "mobile_purchases": filters.mobile_purchases,
    "top_churn_risk": filters.top_churn_risk,
    "checkout_eligible_customers": filters.checkout_eligible_customers,
    "saas_eligible_customers": filters.saas_eligible_customers,
    "purchase_events": filters.purchase_events,
    "monthly_activity": filters.monthly_activity,
    "monthly_activity_head": filters.monthly_activity_head,
    "customer_channel_dates": filters.customer_channel_dates,
    "customer_signup_dates": filters.customer_signup_dates,
    # joins
    "completed_orders_with_country": joins.completed_orders_with_country,
    "revenue_by_country": joins.revenue_by_country,
    "total_spend_all_customers": joins.total_spend_all_customers,
    "country_buyers_semi": lambda t: joins.country_buyers_semi(t, BUYER_COUNTRY),
    "country_buyers_cte": lambda t: joins.country_buyers_cte(t, BUYER_COUNTRY),
    "avg_buyer_spend_by_channel": joins.avg_buyer_spend_by_channel,
    "retention_selfjoin": lambda t: metrics.retention_selfjoin(t.orders, "order_date"),
    "combine_scores": _combine_scores,
    "feature_left_joins": features.feature_left_joins,
    "cohort_left_joins": metrics.cohort_left_joins,
    # aggregates
    "channel_totals": aggregates.channel_totals,
    "popular_products": lambda t: aggregates.popular_products(t, MIN_ORDERS),
    "customers_by_country": aggregates.customers_by_country,
    "event_counts": aggregates.event_counts,
    "variant_counts": aggregates.variant_counts,
    "ab_conversion": aggregates.ab_conversion,
    "ab_conversion_by_year": aggregates.ab_conversion_by_year,
    "customer_growth": aggregates.customer_growth,
    "spend_trend_by_channel": aggregates.spend_trend_by_channel,
    "spend_trend_monthly": aggregates.spend_trend_monthly,
    "customer_breakdown": aggregates.customer_breakdown,
    "funnel_by_year": aggregates.funnel_by_year,
    "funnel_all_time": aggregates.funnel_all_time,
    "risk_propensity_bands": aggregates.risk_propensity_bands,
    "churn_bands_by_year": aggregates.churn_bands_by_year,
    "propensity_bands_by_year": aggregates.propensity_bands_by_year,
    "conditional_counts": aggregates.browse_stats,
    "engagement_counts": aggregates.engagement_counts,
    "target_summary": _target_summary,
    "class_rate": lambda t: aggregates.class_rate(_split_churn(t), "churned"),
    # windows
    "spend_rank_in_country": windows.spend_rank_in_country,
    "running_channel_cost": windows.running_channel_cost,
    "funnel_stage_lag": windows.funnel_stage_lag,
    "funnel_conversion": windows.funnel_conversion,
    # metrics
    "channel_clean": metrics.channel_names,
    "cac_by_channel": metrics.cac_by_channel,
    "roas_by_channel": metrics.roas_by_channel,
    "retention_monthly": metrics.retention_monthly,
    "retention_orders_monthly": lambda t: metrics.retention(t.orders, "order_date"),
    "retention_events_weekly": lambda t: metrics.retention(t.ga4_events, "event_date", "week"),
    "retention_events_daily": lambda t: metrics.retention(t.ga4_events, "event_date", "day"),
    "retention_curve": lambda t: metrics.retention_curve(t.orders, "order_date"),
    "retention_by_year": lambda t: metrics.retention_by_year(t.orders, "order_date"),
    "customer_ltv": lambda t: metrics.customer_ltv(t, AS_OF),
    "top_ltv_customers": lambda t: metrics.top_ltv_customers(t, AS_OF),
    "ltv_to_cac": lambda t: metrics.ltv_to_cac(t, AS_OF),
    "channel_performance": lambda t: metrics.channel_performance(t, AS_OF),
    "channel_performance_by_year": lambda t: metrics.channel_performance_by_year(t, AS_OF),
    # features
    "churn_features": lambda t: features.churn_features(t, AS_OF),
    "churn_scoring_features": lambda t: features.churn_scoring_features(t, AS_OF),
    "propensity_features": lambda t: features.propensity_features(t, AS_OF),
    "propensity_scoring_features": lambda t: features.propensity_scoring_features(t, AS_OF),
    "ltv_features": lambda t: features.ltv_features(t, AS_OF),
    "engagement_rate": lambda t: features.churn_features(t, AS_OF).select(
        "customer_id", "tenure_months", "active_days", "engagement_rate"
    ),
    "log_target": lambda t: rounded(
        features.log_target(metrics.customer_value(t, AS_OF).select("customer_id", "total_ltv")), log_ltv=6, back=2
    ),
    "one_hot_drop_first": _one_hot,
    "one_hot_sparse": _one_hot_sparse,
    "align_features": _align,
    # splits, weights and metrics of fixed predictions
    "stratified_split": lambda t: _split_churn(t).select("customer_id", "churned", "is_test"),
    "random_split": lambda t: ids.hold_out(
        metrics.customer_value(t, AS_OF).select("customer_id", "total_ltv"), "customer_id"
    ),
    "class_weights": lambda t: rounded(class_weights(features.propensity_features(t, AS_OF), "purchased"), weight=6),
    "confusion_matrix": lambda t: evaluate.confusion_matrix(_guesses(t)),
    "classification_report": lambda t: rounded(
        evaluate.classification_report(_guesses(t)), precision=6, recall=6, f1=6
    ),
    "regression_report": lambda t: rounded(
        evaluate.regression_report(_fixed_values(t), "fixed"), rmse=4, mae=4, r2=6
    ),
    "actual_vs_predicted_fixed": lambda t: rounded(
        evaluate.actual_vs_predicted(_fixed_values(t)), avg_actual=4, avg_predicted=4, bias=4
    ),
    # experiment
    "ab_z_test": lambda t: rounded(experiment.ab_z_test(t), rate_a=6, rate_b=6, z=6),
    "ab_p_value": lambda t: rounded(experiment.ab_p_value(t), chi_square=6, p_value=6),
    "ab_decision": lambda t: rounded(experiment.ab_decision(t), z=6),
    "ab_lift": experiment.ab_lift,
    "assign_variants": lambda t: ids.assign_variants(filters.checkout_eligible_customers(t), "checkout_redesign"),
    # data quality
    "dq_primary_key": _quality_keys,
    "dq_foreign_key": _quality_parents,
    "dq_not_null": _quality_filled,
    "dq_domain": _quality_domains,
    "dq_funnel_shape": quality.funnel_shape,
    "dq_click_implies_open": quality.click_implies_open,
    "dq_order_total": _quality_totals,
    "dq_orders_vs_purchases": quality.orders_vs_purchases,
    "dq_end_date_status": lambda t: quality.end_date_status(t, AS_OF),
    "dq_spend_grid": quality.spend_grid,
    "dq_channel_mapping": quality.channel_mapping,
    "dq_source_matches_channel": _quality_sources,
    "dq_variant_balance": quality.variant_balance,
    # reports
    "report_years": lambda t: reports.report_years(aggregates.customer_growth(t)),
    "report_growth": lambda t: reports.report_growth(aggregates.customer_growth(t)),
    "report_growth_year": lambda t: reports.report_growth(aggregates.customer_growth(t), REPORT_YEAR),
    "report_spend_pivot": lambda t: reports.report_spend_pivot(aggregates.spend_trend_by_channel(t)),
    "report_kpis": lambda t: reports.report_kpis(aggregates.customer_growth(t), metrics.channel_performance(t, AS_OF)),
    "report_kpis_year": lambda t: reports.report_kpis(
        aggregates.customer_growth(t), metrics.channel_performance_by_year(reports.cohort_tables(t, REPORT_YEAR), AS_OF), REPORT_YEAR
    ),
    "report_funnel_pct": lambda t: reports.report_funnel_pct(aggregates.funnel_by_year(t)),
    "report_retention": lambda t: reports.report_retention(
        metrics.retention_by_year(t.between(*reports.year_span(REPORT_YEAR, months_after=1)).orders, "order_date"), REPORT_YEAR
    ),
    "report_churn_bands": lambda t: reports.report_churn_bands(aggregates.churn_bands_by_year(t)),
    "report_churn_bands_year": lambda t: reports.report_churn_bands(
        aggregates.churn_bands_by_year(reports.cohort_tables(t, REPORT_YEAR)), REPORT_YEAR
    ),
    "report_propensity_bands": lambda t: reports.report_propensity_bands(aggregates.propensity_bands_by_year(t)),
    "report_band_share": lambda t: reports.report_band_share(
        reports.report_propensity_bands(aggregates.propensity_bands_by_year(t))
    ),
    "report_ab": _ab_every_year,
    "export_bundle": _document_and_back,
    "export_csvs": _csvs_and_back,
}


ORACLES.update(FACT_ORACLES | FIXED_ORACLES)


def _table_query(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, folder: plain(build(tables(spark, folder)))


def _model_query(build: Callable[[SparkSession, Lab], DataFrame]) -> Query:
    return lambda spark, folder: plain(build(spark, lab(spark, folder)))


FACT_QUERIES = fact_queries(_save_and_back)

QUERIES: dict[str, Query] = {
    **{name: _table_query(build) for name, build in (TABLE_QUERIES | FIXED_QUERIES).items()},
    **{name: _model_query(build) for name, build in MODEL_QUERIES.items()},
    **{name: _model_query(build) for name, build in FACT_QUERIES.items()},
}
