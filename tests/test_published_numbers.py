"""Rollups, ratios and experiment statistics on the published figures of the business."""

from datetime import date
from decimal import Decimal as D

import pytest

from larkspur.operators import experiment, windows
from larkspur.operators.aggregates import ab_conversion, funnel
from larkspur.plans import metrics, reports

MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


@pytest.fixture(scope="module")
def experiment_tables(make):
    rows = []
    for variant, assigned, converted in (("A", 3484, 840), ("B", 3432, 997)):
        rows += [
            {"assignment_id": len(rows) + i, "variant": variant, "experiment_name": "checkout_redesign",
             "assigned_date": date(2026, 7, 1), "converted": i < converted}
            for i in range(assigned)
        ]
    return make(ab_test_assignments=rows)


def test_conversion_rates(experiment_tables, rows):
    assert rows(ab_conversion(experiment_tables)) == [("A", 3484, 840, D("24.11")), ("B", 3432, 997, D("29.05"))]


def test_significance(experiment_tables):
    t = experiment_tables
    z = experiment.ab_z_test(t).first().z
    assert z == pytest.approx(-4.650659, abs=1e-6)
    p = experiment.ab_p_value(t).first()
    assert p.p_value == pytest.approx(3.30875e-06, rel=1e-4)
    assert p.chi_square == pytest.approx(z * z, rel=1e-9)
    decision = experiment.ab_decision(t).first()
    assert decision.significant and decision.lift_pt == pytest.approx(4.94)
    assert not experiment.ab_decision(t, alpha=1e-6).first().significant
    assert experiment.ab_lift(t).first().lift_pt == D("4.94")
    assert experiment.ab_decision(t, experiment="another").first().z is None


@pytest.fixture(scope="module")
def yearly_funnel(spark):
    stages = ("page_view", "view_item", "add_to_cart", "begin_checkout", "purchase")
    counts = {
        2024: (10520, 5772, 1784, 978, 625),
        2025: (49266, 27044, 8175, 4514, 2959),
        2026: (38420, 21164, 6345, 3521, 2273),
    }
    rows = [(y, s, n) for y, ns in counts.items() for s, n in zip(stages, ns, strict=True)]
    return spark.createDataFrame(rows, "year int, event_name string, event_count long")


def test_funnel(yearly_funnel, rows):
    whole = funnel(yearly_funnel, by_year=False)
    assert [r.event_count for r in whole.collect()] == [98206, 53980, 16304, 9013, 5857]
    assert [r[3] for r in rows(windows.stage_shares(whole))] == [None, D("55.0"), D("30.2"), D("55.3"), D("65.0")]
    shown = reports.report_funnel_pct(funnel(yearly_funnel, by_year=True), 2024)
    assert rows(shown)[1] == (2024, "View Item", 5772, D("54.9"))
    assert [r.pct for r in reports.report_funnel_pct(whole).collect()] == [D("100.0"), D("55.0"), D("16.6"), D("9.2"), D("6.0")]


@pytest.fixture(scope="module")
def cohorts(spark):
    """Customers, average value, spend and revenue per sign-up year and channel."""
    published = [
        (2024, "Google", 1142, D("356.35"), D("22084.36"), D("74764.49")),
        (2024, "Meta", 909, D("328.04"), D("11806.52"), D("64462.70")),
        (2025, "Google", 2962, D("249.41"), D("60724.69"), D("155283.48")),
        (2025, "Meta", 2530, D("243.75"), D("32557.55"), D("128359.81")),
        (2026, "Google", 1861, D("91.40"), D("39039.28"), D("72328.96")),
        (2026, "Meta", 1587, D("82.21"), D("19561.49"), D("51300.90")),
    ]
    value = spark.createDataFrame(
        [(y, c, n, ltv * n, rev) for y, c, n, ltv, _, rev in published],
        "year int, channel string, new_customers long, value decimal(20,2), total_revenue decimal(20,2)",
    )
    spend = spark.createDataFrame(
        [(y, c, s) for y, c, _, _, s, _ in published], "year int, channel string, total_spend decimal(20,2)"
    )
    return value, spend


def test_channel_performance(cohorts):
    by_year = {(r.year, r.channel): r for r in metrics.performance_by_year(*cohorts).collect()}
    assert [by_year[2024, c].cac for c in ("Google", "Meta")] == [D("19.34"), D("12.99")]
    assert [by_year[2025, c].roas for c in ("Google", "Meta")] == [D("2.56"), D("3.94")]
    ratios = {k: r.ltv_to_cac_ratio for k, r in by_year.items()}
    assert (ratios[2024, "Meta"], ratios[2025, "Google"], ratios[2026, "Meta"]) == (D("25.26"), D("12.17"), D("6.67"))
    whole = {r.channel: r for r in metrics.performance_all_time(*cohorts).collect()}
    assert (whole["Google"].total_spend, whole["Meta"].total_spend) == (D("121848.33"), D("63925.56"))
    assert (whole["Google"].cac, whole["Meta"].cac) == (D("20.43"), D("12.72"))
    assert (whole["Google"].roas, whole["Meta"].roas) == (D("2.48"), D("3.82"))
    assert (whole["Google"].ltv_to_cac_ratio, whole["Meta"].ltv_to_cac_ratio) == (D("10.80"), D("16.35"))


@pytest.fixture(scope="module")
def growth(spark):
    counts = {
        2024: (398, 799, 819, 871, 879),
        2025: (806, 774, 818, 800, 794, 811, 873, 861, 804, 881, 847, 876),
        2026: (816, 767, 851, 836, 859, 860, 811, 489),
    }
    first = {2024: 8, 2025: 1, 2026: 1}
    rows = [(y, MONTHS[first[y] + i - 1], first[y] + i, n) for y, ns in counts.items() for i, n in enumerate(ns)]
    return spark.createDataFrame(rows, "year int, month string, month_num int, customers long")


def test_growth_and_headline_figures(growth, cohorts, rows):
    assert rows(reports.report_years(growth)) == [(2024,), (2025,), (2026,)]
    shown = rows(reports.report_growth(growth))
    assert [m for m, _ in shown] == list(MONTHS) and sum(n for _, n in shown) == 20_000
    assert rows(reports.report_growth(growth, 2024)) == list(zip(MONTHS[7:], (398, 799, 819, 871, 879), strict=True))
    whole = reports.report_kpis(growth, metrics.performance_all_time(*cohorts)).first()
    assert (whole.customers, whole.best_ratio, whole.best_channel) == (20_000, D("16.35"), "Meta")
    year = reports.report_kpis(growth, metrics.performance_by_year(*cohorts), 2024).first()
    assert year.customers == 3766 and year.total_ltv == D("356.35") * 1142 + D("328.04") * 909
    empty = reports.report_kpis(growth, metrics.performance_by_year(*cohorts), 1999).first()
    assert tuple(empty) == (0, 0, 0, 0, "—")


def test_spend_pivot(spark, rows):
    trend = spark.createDataFrame(
        [
            (2024, "Aug", 8, "Google", D("1835.30")),
            (2024, "Aug", 8, "Meta", D("1195.51")),
            (2025, "Aug", 8, "Google", D("5526.82")),
            (2025, "Jan", 1, "Google", D("5959.80")),
        ],
        "year int, month string, month_num int, channel string, spend decimal(12,2)",
    )
    assert rows(reports.report_spend_pivot(trend)) == [("Jan", D("5959.80"), 0), ("Aug", D("7362.12"), D("1195.51"))]
    assert rows(reports.report_spend_pivot(trend, 2024)) == [("Aug", D("1835.30"), D("1195.51"))]


def test_band_reports(spark, rows):
    churn = spark.createDataFrame(
        [
            (2024, "Low Risk", 1184, D("485.93")),
            (2025, "Low Risk", 1148, D("387.28")),
            (2025, "Medium Risk", 1701, D("298.64")),
            (2025, "High Risk", 181, D("244.74")),
            (2026, "Medium Risk", 1370, D("94.90")),
            (2026, "High Risk", 641, D("124.21")),
        ],
        "year int, churn_risk_band string, customer_count long, avg_predicted_ltv decimal(12,2)",
    )
    whole = rows(reports.report_churn_bands(churn))
    assert [r[:2] for r in whole] == [("Low Risk", 2332), ("Medium Risk", 3071), ("High Risk", 822)]
    assert whole[0][2] == D("437.37")
    assert rows(reports.report_churn_bands(churn, 2024)) == [("Low Risk", 1184, D("485.93"))]
    assert [r.share for r in reports.report_band_share(reports.report_churn_bands(churn)).collect()] == [37, 49, 13]
    propensity = spark.createDataFrame(
        [
            (2024, "Low", 685), (2024, "Medium", 1293), (2024, "High", 1788),
            (2025, "Low", 2377), (2025, "Medium", 3724), (2025, "High", 3844),
            (2026, "Low", 2389), (2026, "Medium", 2647), (2026, "High", 1253),
        ],
        "year int, propensity_band string, customer_count long",
    )
    assert rows(reports.report_propensity_bands(propensity)) == [("Low", 5451), ("Medium", 7664), ("High", 6885)]


def test_experiment_report_shows_years_without_data(spark, growth, rows):
    by_year = spark.createDataFrame(
        [(2026, "A", 3484, 840, D("24.11")), (2026, "B", 3432, 997, D("29.05"))],
        "year int, variant string, total_assigned long, total_converted long, conversion_rate_pct decimal(6,2)",
    )
    all_time = by_year.drop("year")
    assert rows(reports.report_ab(growth, by_year, all_time, 2024)) == [(None, None, None, None, False)]
    assert [r.variant for r in reports.report_ab(growth, by_year, all_time, 2026).collect()] == ["A", "B"]
    assert len(rows(reports.report_ab(growth, by_year, all_time))) == 2
    assert [r.has_data for r in reports.report_ab_every_year(growth, by_year).collect()] == [False, False, True, True]
