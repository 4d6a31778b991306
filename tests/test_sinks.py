"""Files and tables written and read back."""

import json
from datetime import date, datetime
from decimal import Decimal as D
from pathlib import Path

import pytest
from places import STAR
from pyspark.sql import functions as F

from larkspur import Tables
from larkspur.catalog import QUERIES
from larkspur.operators import aggregates
from larkspur.plans import exports, reports
from larkspur.sources import sinks
from larkspur.sources.schemas import PRIMARY_KEYS, SCHEMAS
from larkspur.sources.star import AS_OF
from larkspur.sources.tables import read_table


def test_schemas_declare_every_table():
    assert set(SCHEMAS) == set(PRIMARY_KEYS) and len(SCHEMAS) == 8
    for name, schema in SCHEMAS.items():
        assert not schema[PRIMARY_KEYS[name]].nullable
    assert SCHEMAS["ga4_events"]["customer_id"].nullable and SCHEMAS["subscriptions"]["end_date"].nullable
    assert SCHEMAS["customer_scores"]["churn_risk_score"].dataType.simpleString() == "decimal(5,4)"


def test_csv_round_trip_with_declared_schema(spark, make, tmp_path):
    t = make(orders=[{"order_id": 1, "customer_id": 2, "order_date": date(2026, 1, 2), "product_name": "Gift Card",
                      "quantity": 1, "unit_price": D("5.00"), "total_amount": D("5.00"), "order_status": "completed"}])
    sinks.write_csv(t.orders, str(tmp_path / "orders"))
    header = next(p for p in (tmp_path / "orders").glob("*.csv")).read_text().splitlines()[0]
    assert header == ",".join(SCHEMAS["orders"].names)
    assert read_table(spark, "orders", str(tmp_path / "orders"), "csv").collect() == t.orders.collect()


def test_csv_export(spark, star, tmp_path):
    exports.export_csvs(star, AS_OF, str(tmp_path))
    names = {p.name for p in tmp_path.iterdir()}
    assert names == {"channel_performance", "funnel_conversion", "retention_curve", "ml_risk_bands", "ab_test_results",
                     "spend_trend", "customer_breakdown"}
    for name in names:
        files = list((tmp_path / name).glob("*.csv"))
        assert len(files) == 1 and len(files[0].read_text().splitlines()) > 1
    first = next((tmp_path / "channel_performance").glob("*.csv")).read_text().splitlines()[0]
    assert first == "channel,total_spend,new_customers,cac,total_revenue,roas,avg_ltv,ltv_to_cac_ratio"


SECTIONS = ["customer_growth", "spend_trend", "channel_performance_by_year", "channel_performance_all_time", "funnel_by_year",
            "funnel_all_time", "retention_by_year", "churn_risk_bands_by_year", "propensity_bands_by_year", "ab_test_by_year",
            "ab_test_all_time"]


@pytest.fixture(scope="module")
def datasets(star):
    return exports.json_datasets(star, AS_OF)


def test_json_document(star, datasets, tmp_path):
    exports.export_bundle(star, AS_OF, str(tmp_path / "dashboard.json"))
    document = json.loads((tmp_path / "dashboard.json").read_text())
    assert list(document) == SECTIONS == list(datasets)
    for name, frame in datasets.items():
        assert len(document[name]) == frame.count()
    growth = document["customer_growth"]
    assert [(r["year"], r["month_num"]) for r in growth] == sorted((r["year"], r["month_num"]) for r in growth)
    assert sum(r["customers"] for r in growth) == 150
    assert set(document["ab_test_all_time"][0]) == {"variant", "total_assigned", "total_converted", "conversion_rate_pct"}


def test_json_document_keeps_empty_and_large_sections(spark, tmp_path):
    frames = {"none": spark.range(0), "some": spark.range(3), 'large "one"': spark.range(10_001), "last": spark.range(0)}
    sinks.write_json_document(frames, str(tmp_path / "doc.json"))
    sinks.write_json_document(frames, str(tmp_path / "doc.json"))  # takes the place of the first
    with open(tmp_path / "doc.json") as file:
        document = json.load(file)
    assert [f.name for f in tmp_path.iterdir() if not f.name.startswith(".")] == ["doc.json"]
    assert document == {n: [{"id": i} for i in range(k)] for n, k in zip(frames, (0, 3, 10_001, 0), strict=True)}


def test_refresh_refuses_other_columns(spark, tmp_path):
    sinks.full_refresh(spark.range(3), "refresh_shape", str(tmp_path / "it's"))
    with pytest.raises(ValueError, match="other columns"):
        sinks.full_refresh(spark.range(3).selectExpr("cast(id AS string) AS id"), "refresh_shape", str(tmp_path / "it's"))
    sinks.full_refresh(spark.range(5), "refresh_shape", str(tmp_path / "it's"))
    assert spark.table("refresh_shape").count() == 5


def test_a_year_reads_only_its_months(spark, make, tmp_path):
    days = [date(y, m, 3) for y in (2025, 2026) for m in (1, 6, 12)]
    t = make(
        ga4_events=[{"event_id": i, "event_date": d, "event_name": "page_view"} for i, d in enumerate(days)],
        marketing_spend=[{"spend_id": i, "spend_date": d, "channel": "Google Ads", "cost": D("5")} for i, d in enumerate(days)],
    )
    for name in ("ga4_events", "marketing_spend"):
        sinks.store_table(getattr(t, name), name, str(tmp_path / name))
    stored = Tables.from_folder(spark, str(tmp_path))
    year = stored.between(date(2026, 1, 1), date(2026, 12, 31))
    for build in (
        lambda x: reports.report_funnel_pct(aggregates.funnel_by_year(x), 2026),
        lambda x: reports.report_spend_pivot(aggregates.spend_trend_by_channel(x), 2026),
    ):
        pruned, whole = build(year), build(stored)
        assert pruned.collect() == whole.collect() == build(t).collect() == build(t.between(date(2026, 1, 1), date(2026, 12, 31))).collect()
        assert "PartitionFilters: [isnotnull(month" in pruned._jdf.queryExecution().executedPlan().toString()


def test_json_folders(spark, datasets, tmp_path):
    sinks.write_json({n: datasets[n] for n in SECTIONS[:2]}, str(tmp_path))
    assert spark.read.json(str(tmp_path / "customer_growth")).count() == datasets["customer_growth"].count()


def test_unknown_types_become_text(spark):
    frame = spark.sql("SELECT DATE '2026-01-02' AS d, CAST(1.5 AS DECIMAL(5,2)) AS m, true AS b, NULL AS n")
    assert [f.dataType.simpleString() for f in sinks.json_ready(frame).schema] == ["string", "double", "boolean", "string"]


def test_dashboard_from_the_exported_tables(datasets):
    whole, year = reports.dashboard(datasets), reports.dashboard(datasets, 2000)
    assert set(whole) == set(year)
    assert whole["kpis"].first().customers == 150 > year["kpis"].first().customers
    assert year["ab_test"].first().has_data is False


def _scores(spark, *ids):
    at = datetime(2026, 1, 1)
    return spark.createDataFrame([(i, None, D("0.5"), D("10"), at) for i in ids], SCHEMAS["customer_scores"])


def test_full_refresh_replaces_all_rows(spark, tmp_path):
    folder = str(tmp_path / "scores")
    sinks.full_refresh(_scores(spark, 1, 2, 3), "refresh_all", folder)
    sinks.full_refresh(_scores(spark, 4), "refresh_all", folder)
    assert [r.customer_id for r in spark.table("refresh_all").collect()] == [4]
    sinks.truncate_reset(spark, "refresh_all", folder)
    assert spark.table("refresh_all").count() == 0
    assert spark.table("refresh_all").columns == SCHEMAS["customer_scores"].names


def test_failed_refresh_leaves_the_old_rows(spark, tmp_path):
    folder = str(tmp_path / "scores")
    sinks.full_refresh(_scores(spark, 1, 2), "refresh_failed", folder)
    broken = _scores(spark, 7, 8).withColumn("customer_id", F.when(F.col("customer_id") == 8, F.raise_error(F.lit("stop"))).otherwise(F.col("customer_id")))
    with pytest.raises(Exception, match="stop"):
        sinks.full_refresh(broken, "refresh_failed", folder)
    assert sorted(r.customer_id for r in spark.table("refresh_failed").collect()) == [1, 2]


def test_load_once_and_append(spark, tmp_path):
    folder = str(tmp_path / "rows")
    sinks.load_once(spark.range(3), folder)
    with pytest.raises(ValueError, match="already has rows"):
        sinks.load_once(spark.range(3), folder)
    sinks.bulk_append(spark.range(3, 5), folder)
    assert sorted(r.id for r in spark.read.parquet(folder).collect()) == [0, 1, 2, 3, 4]


def test_load_once_into_a_folder_of_no_rows(spark, tmp_path):
    folder = str(tmp_path / "rows")
    spark.range(0).write.parquet(folder)
    sinks.load_once(spark.range(2), folder)
    assert spark.read.parquet(folder).count() == 2


def test_stored_facts_are_pruned_by_month(spark, make, tmp_path):
    days = [date(2026, m, d) for m in (1, 2, 3) for d in (1, 15)]
    t = make(ga4_events=[{"event_id": i, "event_date": d, "event_name": "page_view"} for i, d in enumerate(days)])
    folder = str(tmp_path / "ga4_events")
    sinks.store_table(t.ga4_events, "ga4_events", folder)
    assert {p.name for p in Path(folder).iterdir() if p.is_dir()} == {"month=2026-01", "month=2026-02", "month=2026-03"}
    stored = Tables.from_folder(spark, str(tmp_path)).ga4_events
    assert stored.columns == SCHEMAS["ga4_events"].names and stored.count() == 6
    one = read_table(spark, "ga4_events", folder, since=date(2026, 2, 10), until=date(2026, 2, 28))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1 and "PartitionFilters: [isnotnull(month" in plan


def test_registered_year_report_pushes_its_range_to_the_files(spark):
    plan = QUERIES["report_retention"](spark, STAR)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate," in plan and "LessThan(o_orderdate," in plan


def test_year_span():
    assert reports.year_span(2024) == (date(2024, 1, 1), date(2024, 12, 31))
    assert reports.year_span(2024, months_after=1) == (date(2024, 1, 1), date(2025, 1, 31))


def test_year_reports_read_their_cohort(spark):
    plan = QUERIES["report_kpis_year"](spark, STAR)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate," in plan
