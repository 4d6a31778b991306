"""Hand-made rows for the cases that are easy to get wrong."""

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from larkspur.functions.dates import whole_months
from larkspur.functions.labels import churn_band
from larkspur.functions.money import ratio
from larkspur.operators import aggregates, filters, joins, windows
from larkspur.plans import features, metrics

TODAY = date(2026, 8, 15)


@pytest.mark.parametrize(
    "start, end, months",
    [
        (date(2024, 1, 31), date(2024, 2, 29), 0),
        (date(2024, 2, 29), date(2024, 3, 31), 1),
        (date(2024, 2, 29), date(2025, 2, 28), 11),
        (date(2024, 3, 10), date(2024, 3, 1), 0),
        (date(2024, 3, 10), date(2024, 1, 9), -2),
        (date(2020, 5, 5), date(2024, 5, 5), 48),
    ],
)
def test_whole_months(spark, start, end, months):
    frame = spark.createDataFrame([(start, end)], "a date, b date")
    assert frame.select(whole_months(F.col("a"), F.col("b"))).first()[0] == months


def test_subscription_pays_at_least_one_month_but_tenure_does_not(make):
    t = make(
        customers=[{"customer_id": 1, "customer_type": "saas"}, {"customer_id": 2, "customer_type": "saas"}],
        subscriptions=[
            {"subscription_id": 1, "customer_id": 1, "start_date": date(2026, 8, 10), "mrr": D("15.00"), "status": "active"},
            {"subscription_id": 2, "customer_id": 2, "start_date": date(2026, 8, 20), "mrr": D("15.00"), "status": "active"},
        ],
    )
    assert {r.customer_id: r.saas_ltv for r in metrics.customer_ltv(t, TODAY).collect()} == {1: D("15.00"), 2: D("15.00")}
    assert {r.tenure_months for r in features.churn_features(t, TODAY).collect()} == {0}


def _events(*names):
    return [{"event_id": i, "customer_id": 1, "event_date": TODAY, "event_name": n} for i, n in enumerate(names)]


def test_unknown_stage_comes_last(make, rows):
    stages = [s for s, n in (("page_view", 4), ("view_item", 2), ("purchase", 1), ("scroll", 3)) for _ in range(n)]
    lag = rows(windows.funnel_stage_lag(make(ga4_events=_events(*stages))))
    assert [r[0] for r in lag] == ["page_view", "view_item", "purchase", "scroll"]
    assert lag[-1] == ("scroll", 3, 1, D("300.0"))
    shares = rows(windows.funnel_conversion(make(ga4_events=_events(*stages))))
    assert [r[2] for r in shares] == [D("100.0"), D("50.0"), D("25.0"), D("75.0")]


def _spend(*items):
    return [
        {"spend_id": i, "spend_date": d, "channel": c, "campaign_name": str(i), "cost": D(cost), "clicks": 1,
         "impressions": 1, "conversions": 1}
        for i, (d, c, cost) in enumerate(items)
    ]


def test_rows_of_one_day_share_the_running_total(make):
    t = make(marketing_spend=_spend((date(2026, 1, 1), "Google Ads", "10"), (date(2026, 1, 1), "Google Ads", "20"),
                                    (date(2026, 1, 2), "Google Ads", "5")))
    assert sorted(r.running_total_cost for r in windows.running_channel_cost(t).collect()) == [30, 30, 35]


def test_unmapped_platforms_stay_apart_or_merge(make):
    t = make(marketing_spend=_spend((date(2026, 1, 1), "X Ads", "10"), (date(2026, 1, 1), "Y Ads", "20")))
    assert [r.channel for r in aggregates.spend_trend_by_channel(t).collect()] == [None, None]
    assert [(r.channel_clean, r.daily_cost) for r in aggregates.spend_trend_monthly(t).collect()] == [(None, 30)]


def test_both_value_to_cost_ratios(spark):
    customers, spend, value = 909, D("11806.52"), D("328.04") * 909
    frame = spark.createDataFrame([(customers, spend, value)], "n long, spend decimal(12,2), value decimal(12,2)")
    cac = ratio(F.col("spend"), F.col("n"))
    line = frame.select(ratio(F.col("value"), F.col("spend")), ratio(F.col("value"), cac * F.col("n"))).first()
    assert tuple(line) == (D("25.26"), D("25.25"))


def test_score_is_rounded_before_banding(spark):
    frame = spark.createDataFrame([(0.49996,), (0.2999,), (None,)], "s double")
    assert [r[0] for r in frame.select(churn_band(F.col("s"))).collect()] == ["High Risk", "Low Risk", None]


def test_engagement_rate_in_training_and_scoring(make):
    days = [{"event_id": i, "customer_id": 1, "event_date": date(2026, 8, i), "event_name": "page_view"} for i in (1, 2, 3, 4)]
    t = make(
        customers=[{"customer_id": 1, "customer_type": "both"}],
        subscriptions=[{"subscription_id": 1, "customer_id": 1, "start_date": TODAY, "mrr": D("15"), "status": "active"}],
        ga4_events=days,
    )
    assert features.churn_features(t, TODAY).first().engagement_rate == 4.0
    assert features.churn_scoring_features(t, TODAY).first().engagement_rate == 4.0
    assert features.churn_scoring_features(t, TODAY, compat_zero_fill=True).first().engagement_rate == 0.0


def test_mobile_share_counts_browsing_events_only(make):
    kinds = [("page_view", "mobile"), ("page_view", "mobile"), ("view_item", "desktop"), ("purchase", "mobile")]
    t = make(ga4_events=[
        {"event_id": i, "customer_id": 1, "event_date": TODAY, "event_name": n, "device_category": d, "session_id": "s"}
        for i, (n, d) in enumerate(kinds)
    ])
    assert aggregates.browse_stats(t).first().mobile_session_pct == D("66.7")


def test_customer_without_completed_order_keeps_a_null(make, rows):
    t = make(
        customers=[{"customer_id": 1, "country": "Canada"}],
        orders=[{"order_id": 1, "customer_id": 1, "order_date": TODAY, "total_amount": D("9"), "order_status": "refunded"}],
    )
    assert rows(joins.total_spend_all_customers(t)) == [(1, "Canada", None)]
    assert rows(joins.country_buyers_semi(t, "Canada")) == rows(joins.country_buyers_cte(t, "Canada")) == []


def _visits(*pairs):
    return [{"event_id": i, "customer_id": c, "event_date": d, "event_name": "begin_checkout"} for i, (c, d) in enumerate(pairs)]


def test_last_month_retains_nobody_and_unknown_customers_are_skipped(make, rows):
    jan, feb, mar = date(2026, 1, 5), date(2026, 2, 9), date(2026, 3, 9)
    t = make(ga4_events=_visits((1, jan), (1, feb), (2, jan), (None, jan), (None, feb), (None, mar)))
    want = [(date(2026, 1, 1), 2, 1, D("50.0")), (date(2026, 2, 1), 1, 0, D("0.0")), (date(2026, 3, 1), 0, 0, None)]
    assert rows(metrics.retention(t.ga4_events, "event_date")) == want
    assert rows(metrics.retention_selfjoin(t.ga4_events, "event_date")) == want
    assert sorted(rows(filters.checkout_eligible_customers(t))) == [(1,), (2,)]


def test_channel_with_spend_and_no_customers(make, rows):
    t = make(
        marketing_spend=_spend((date(2026, 1, 1), "Google Ads", "10")),
        customers=[{"customer_id": 1, "signup_date": date(2026, 1, 1), "acquisition_channel": "Meta"}],
    )
    assert rows(metrics.cac_by_channel(t)) == []
    line = metrics.channel_performance_by_year(t, TODAY).first()
    assert (line.channel, line.total_spend, line.cac, line.ltv_to_cac_ratio) == ("Meta", None, None, None)


def test_customer_in_one_score_set_only(spark):
    def scores(column, *items):
        return spark.createDataFrame(list(items), f"customer_id long, {column} double")

    merged = joins.combine_scores(
        scores("churn_risk_score", (3, 0.9)), scores("purchase_propensity_score", (1, 0.5)),
        scores("predicted_ltv", (1, 10.0), (2, 20.0)), __import__("datetime").datetime(2026, 1, 1),
    )
    got = {r.customer_id: (r.churn_risk_score, r.purchase_propensity_score, r.predicted_ltv) for r in merged.collect()}
    assert got == {1: (None, 0.5, 10.0), 2: (None, None, 20.0), 3: (0.9, None, None)}


def test_all_years_equal_the_sum_of_cohorts(star):
    """Counts, spend and revenue of the all-time table are those of the yearly one, where every year has spend."""
    whole = {r.channel: r for r in metrics.channel_performance(star, date(2001, 12, 31)).collect()}
    by_year = metrics.channel_performance_by_year(star, date(2001, 12, 31)).collect()
    for channel, line in whole.items():
        parts = [r for r in by_year if r.channel == channel]
        assert sum(r.new_customers for r in parts) == line.new_customers
        assert sum(r.total_revenue or 0 for r in parts) == line.total_revenue
