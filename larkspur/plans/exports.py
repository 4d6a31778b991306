"""The two publications: seven CSV datasets for a BI tool and the eleven-part JSON document of a dashboard.

Several datasets show the same facts by year and for all time, or by platform and by channel.  Each fact table is
therefore rolled up once to a few rows per month or year; the rollups are kept, and the datasets are built from them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.labels import channel_clean
from larkspur.functions.money import total
from larkspur.operators import aggregates as agg
from larkspur.operators.scale import keep_all
from larkspur.operators.windows import stage_shares
from larkspur.plans.metrics import (
    cohort_value,
    performance_all_time,
    performance_by_year,
    retention_by_year,
    retention_curve,
)
from larkspur.sources.sinks import write_csvs, write_json, write_json_document
from larkspur.sources.tables import Tables


def csv_datasets(t: Tables, as_of: date) -> dict[str, DataFrame]:
    monthly, cohorts = keep_all({"monthly-spend": agg.monthly_platform_spend(t), "cohorts": cohort_value(t, as_of)})
    return {
        "channel_performance": performance_all_time(cohorts, _spend_by_year(monthly)),
        "funnel_conversion": stage_shares(agg.funnel_all_time(t)),
        "retention_curve": retention_curve(t.ga4_events, "event_date"),
        "ml_risk_bands": agg.risk_propensity_bands(t),
        "ab_test_results": agg.ab_conversion(t),
        "spend_trend": agg.channel_trend(monthly),
        "customer_breakdown": agg.customer_breakdown(t),
    }


def _spend_by_year(monthly: DataFrame) -> DataFrame:
    keys = [F.year("month_start").alias("year"), channel_clean(F.col("platform")).alias("channel")]
    return monthly.groupBy(*keys).agg(total(F.col("cost")).alias("total_spend"))


def json_datasets(t: Tables, as_of: date) -> dict[str, DataFrame]:
    monthly, cohorts, events, bands, variants = keep_all(
        {
            "monthly-spend": agg.monthly_platform_spend(t),
            "cohorts": cohort_value(t, as_of),
            "event-counts": agg.event_counts_by_year(t),
            "score-bands": agg.bands_by_year(t),
            "variant-counts": agg.variant_counts_by_year(t),
        }
    )
    spend = _spend_by_year(monthly)
    return {
        "customer_growth": agg.customer_growth(t),
        "spend_trend": agg.platform_trend(monthly),
        "channel_performance_by_year": performance_by_year(cohorts, spend),
        "channel_performance_all_time": performance_all_time(cohorts, spend),
        "funnel_by_year": agg.funnel(events, by_year=True),
        "funnel_all_time": agg.funnel(events, by_year=False),
        "retention_by_year": retention_by_year(t.ga4_events, "event_date"),
        "churn_risk_bands_by_year": agg.churn_bands(bands),
        "propensity_bands_by_year": agg.propensity_bands(bands),
        "ab_test_by_year": agg.rates_by_year(variants),
        "ab_test_all_time": agg.rates_all_time(variants),
    }


def export_csvs(t: Tables, as_of: date, folder: str) -> list[str]:
    """The seven datasets as one CSV file each; returns their names."""
    datasets = csv_datasets(t, as_of)
    write_csvs(datasets, folder)
    return list(datasets)


def export_bundle(t: Tables, as_of: date, path: str) -> None:
    """The eleven datasets as one JSON document, a single file."""
    write_json_document(json_datasets(t, as_of), path)


def export_json(t: Tables, as_of: date, folder: str) -> None:
    """The eleven datasets as one folder of JSON lines each, for readers that take them one by one."""
    write_json(json_datasets(t, as_of), folder)
