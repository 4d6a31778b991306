"""Report rollups: what a dashboard shows for one year or, with ``year=None``, for all years.

Inputs are the small monthly, yearly and channel tables of ``metrics`` and ``aggregates``, so the windows here run
over a handful of rows.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.labels import CHURN_BANDS, PAID_CHANNELS, PROPENSITY_BANDS, STAGE_TITLES, position
from larkspur.functions.money import percent, ratio, total
from larkspur.sources.tables import Tables


def in_year(rows: DataFrame, year: int | None) -> DataFrame:
    return rows if year is None else rows.where(F.col("year") == year)


def year_span(year: int, months_after: int = 0) -> tuple[date, date]:
    """First and last day of the rows that a report of ``year`` needs; retention looks one month further."""
    end = date(year, 12, 31) if not months_after else date(year + 1, months_after + 1, 1) - timedelta(days=1)
    return date(year, 1, 1), end


def cohort_tables(t: Tables, year: int) -> Tables:
    """The tables as a report on the customers who signed up in ``year`` needs them: these customers, and the year's spend.

    Orders and events stay whole, since a customer's value counts all of them; they meet the year's customers only.
    """
    first, last = year_span(year)
    dated = t.between(first, last)

    def source(name: str) -> DataFrame:
        if name == "customers":
            return t.customers.where(F.col("signup_date").between(F.lit(first), F.lit(last)))
        return dated.marketing_spend if name == "marketing_spend" else getattr(t, name)

    return Tables(source)


def report_years(growth: DataFrame) -> DataFrame:
    return growth.select("year").distinct().orderBy("year")


def report_growth(growth: DataFrame, year: int | None = None) -> DataFrame:
    """New customers per calendar month, January first, summed over the chosen years."""
    months = in_year(growth, year).groupBy("month_num", "month").agg(F.sum("customers").alias("customers"))
    return months.orderBy("month_num").select("month", "customers")


def report_spend_pivot(trend: DataFrame, year: int | None = None) -> DataFrame:
    """Spend per calendar month, one column per paid channel, 0 where a channel has none."""
    months = in_year(trend, year).groupBy("month_num", "month").pivot("channel", list(PAID_CHANNELS))
    wide = months.agg(total(F.col("spend")))
    zero = F.lit(0).cast("decimal(38,2)")
    return wide.orderBy("month_num").select("month", *[F.coalesce(F.col(c), zero).alias(c) for c in PAID_CHANNELS])


def report_kpis(growth: DataFrame, performance: DataFrame, year: int | None = None) -> DataFrame:
    """Customers of all channels; value, mean value and best value-to-cost ratio of the paid channels."""
    people = in_year(growth, year).select(F.col("customers").alias("people"))
    rows = performance if year is None else in_year(performance, year)
    worth = rows.select(
        F.col("avg_ltv").cast("decimal(18,2)").alias("mean"), "new_customers", "ltv_to_cac_ratio", "channel"
    )
    none = F.lit(0).cast("decimal(38,2)")
    # One aggregation over both lists of rows.  Equal ratios: the alphabetically first channel.
    sums = people.unionByName(worth, allowMissingColumns=True).agg(
        F.coalesce(F.sum("people"), F.lit(0)).alias("customers"),
        F.coalesce(F.sum(F.col("mean") * F.col("new_customers")).cast("decimal(38,2)"), none).alias("total_ltv"),
        F.sum("new_customers").alias("won"),
        F.max("ltv_to_cac_ratio").alias("best_ratio"),
        F.min_by("channel", F.when(F.col("channel").isNotNull(), F.struct(-F.col("ltv_to_cac_ratio"), "channel"))).alias("best_channel"),
    )
    return sums.select(
        "customers",
        "total_ltv",
        F.coalesce(ratio(F.col("total_ltv"), F.col("won"), 6), F.lit(0).cast("decimal(24,6)")).alias("avg_ltv"),
        F.coalesce("best_ratio", F.lit(0)).alias("best_ratio"),
        F.coalesce("best_channel", F.lit("—")).alias("best_channel"),
    )


def report_funnel_pct(funnel: DataFrame, year: int | None = None) -> DataFrame:
    """Known stages with their count and share of the first stage, per year when the input has years."""
    rows = in_year(funnel, year).where(F.col("stage_order").isNotNull())
    keys = ["year"] if "year" in funnel.columns else []
    first = F.first("event_count").over(Window.partitionBy(*keys).orderBy("stage_order"))
    titles = F.element_at(F.array(*[F.lit(s) for s in STAGE_TITLES]), F.col("stage_order"))
    share = percent(F.col("event_count"), first, 1)
    shown = rows.select(*keys, "stage_order", titles.alias("stage"), F.col("event_count").alias("value"), share.alias("pct"))
    return shown.orderBy(*keys, "stage_order").drop("stage_order")


def report_retention(months: DataFrame, year: int | None = None) -> DataFrame:
    return in_year(months, year).orderBy("year", "month_num")


def report_churn_bands(bands: DataFrame, year: int | None = None) -> DataFrame:
    """Churn bands in order.  Over several years the mean is weighted by count from the rounded yearly means."""
    worth = F.col("avg_predicted_ltv").cast("decimal(18,2)") * F.col("customer_count")
    rows = in_year(bands, year).groupBy(F.col("churn_risk_band").alias("band")).agg(
        F.sum("customer_count").alias("count"), F.sum(worth).cast("decimal(38,2)").alias("worth")
    )
    shown = rows.withColumn("avg_ltv", ratio(F.col("worth"), F.col("count"))).where(F.col("count") > 0)
    return shown.orderBy(position(F.col("band"), CHURN_BANDS)).select("band", "count", "avg_ltv")


def report_propensity_bands(bands: DataFrame, year: int | None = None) -> DataFrame:
    rows = in_year(bands, year).groupBy(F.col("propensity_band").alias("band")).agg(F.sum("customer_count").alias("count"))
    return rows.where(F.col("count") > 0).orderBy(position(F.col("band"), PROPENSITY_BANDS))


def report_band_share(bands: DataFrame) -> DataFrame:
    """Share of each band, in whole percent, from a report of bands."""
    whole = F.sum("count").over(Window.partitionBy())
    return bands.select("band", percent(F.col("count"), whole, 0).alias("share"))


def report_ab(growth: DataFrame, by_year: DataFrame, all_time: DataFrame, year: int | None = None) -> DataFrame:
    """Experiment rates of a year, or of all time.  A year without assignments gives one row with
    ``has_data`` false."""
    if year is None:
        return all_time.withColumn("has_data", F.lit(True)).orderBy("variant")
    wanted = in_year(report_years(growth), year)
    return _with_gaps(wanted, by_year).drop("year").orderBy("variant")


def report_ab_every_year(growth: DataFrame, by_year: DataFrame) -> DataFrame:
    """``report_ab`` for each year with new customers, in one table."""
    return _with_gaps(report_years(growth), by_year).orderBy("year", "variant")


def _with_gaps(years: DataFrame, by_year: DataFrame) -> DataFrame:
    joined = years.join(by_year, "year", "left")
    return joined.withColumn("has_data", F.col("variant").isNotNull())


def dashboard(datasets: dict[str, DataFrame], year: int | None = None) -> dict[str, DataFrame]:
    """All report tables for one year or all years, from the eleven small tables of the JSON export."""
    growth = datasets["customer_growth"]
    span = "all_time" if year is None else "by_year"
    churn = report_churn_bands(datasets["churn_risk_bands_by_year"], year)
    propensity = report_propensity_bands(datasets["propensity_bands_by_year"], year)
    return {
        "years": report_years(growth),
        "growth": report_growth(growth, year),
        "spend": report_spend_pivot(datasets["spend_trend"], year),
        "kpis": report_kpis(growth, datasets[f"channel_performance_{span}"], year),
        "funnel": report_funnel_pct(datasets[f"funnel_{span}"], year),
        "retention": report_retention(datasets["retention_by_year"], year),
        "churn_bands": churn,
        "churn_share": report_band_share(churn),
        "propensity_bands": propensity,
        "propensity_share": report_band_share(propensity),
        "ab_test": report_ab(growth, datasets["ab_test_by_year"], datasets["ab_test_all_time"], year),
    }
