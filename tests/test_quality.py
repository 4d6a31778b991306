"""Each check finds exactly the one bad row planted for it."""

from datetime import date
from decimal import Decimal as D

import pytest

from larkspur.operators import quality
from larkspur.sources.schemas import VOCABULARY

DAY = date(2026, 1, 5)


@pytest.fixture(scope="module")
def t(make):
    return make(
        customers=[
            {"customer_id": 1, "signup_date": DAY, "acquisition_channel": "Google", "country": "India", "customer_type": "saas"},
            {"customer_id": 2, "signup_date": DAY, "acquisition_channel": "Meta", "country": "India", "customer_type": "robot"},
            {"customer_id": 2, "signup_date": None, "acquisition_channel": None, "country": "India", "customer_type": "both"},
        ],
        marketing_spend=[
            {"spend_id": 1, "spend_date": DAY, "channel": "Google Ads", "campaign_name": "a", "cost": D("1")},
            {"spend_id": 2, "spend_date": DAY, "channel": "Google Ads", "campaign_name": "a", "cost": D("1")},
            {"spend_id": 3, "spend_date": DAY, "channel": "X Ads", "campaign_name": "a", "cost": D("1")},
        ],
        ga4_events=[
            {"event_id": 1, "customer_id": 1, "event_date": DAY, "event_name": "page_view", "traffic_source": "google"},
            {"event_id": 2, "customer_id": 1, "event_date": DAY, "event_name": "page_view", "traffic_source": "email"},
            {"event_id": 3, "customer_id": 9, "event_date": DAY, "event_name": "view_item", "traffic_source": "meta"},
            {"event_id": 4, "customer_id": None, "event_date": DAY, "event_name": "view_item"},
            {"event_id": 5, "customer_id": 1, "event_date": DAY, "event_name": "purchase", "traffic_source": "google"},
        ],
        orders=[
            {"order_id": 1, "customer_id": 1, "order_date": DAY, "quantity": 2, "unit_price": D("5"), "total_amount": D("10")},
            {"order_id": 2, "customer_id": 2, "order_date": DAY, "quantity": 2, "unit_price": D("5"), "total_amount": D("11")},
        ],
        subscriptions=[
            {"subscription_id": 1, "customer_id": 1, "start_date": DAY, "status": "active"},
            {"subscription_id": 2, "customer_id": 1, "start_date": DAY, "status": "cancelled"},
        ],
        crm_engagement=[
            {"engagement_id": 1, "customer_id": 1, "sent_date": DAY, "opened": True, "clicked": True},
            {"engagement_id": 2, "customer_id": 1, "sent_date": DAY, "opened": False, "clicked": True},
            {"engagement_id": 3, "customer_id": 1, "sent_date": DAY, "opened": False, "clicked": None},
        ],
        ab_test_assignments=[{"assignment_id": i, "customer_id": i, "experiment_name": "x", "variant": "A"} for i in range(40)],
    )


def check(frame):
    return {r.check: (r.bad_rows, r.total_rows) for r in frame.collect()}


def test_keys(t):
    assert check(quality.primary_key(t.customers, "customers", "customer_id")) == {"primary_key:customers.customer_id": (1, 3)}
    assert check(quality.foreign_key(t.ga4_events, t.customers, "ga4_events")) == {"foreign_key:ga4_events.customer_id": (1, 5)}


def test_columns(t):
    assert check(quality.not_null(t.customers, "customers", ["signup_date", "country"])) == {
        "not_null:customers.signup_date": (1, 3),
        "not_null:customers.country": (0, 3),
    }
    allowed = {c: v for (table, c), v in VOCABULARY.items() if table == "customers"}
    found = check(quality.domain(t.customers, "customers", allowed))
    assert found["domain:customers.customer_type"] == (1, 3) and found["domain:customers.acquisition_channel"] == (0, 3)


def test_rules_between_columns(t):
    assert check(quality.click_implies_open(t)) == {"click_implies_open": (1, 3)}
    assert check(quality.order_total(t.orders)) == {"order_total": (1, 2)}
    assert check(quality.end_date_status(t, DAY)) == {"end_date_status": (1, 2)}
    assert check(quality.spend_grid(t)) == {"spend_grid": (1, 2)}
    assert check(quality.channel_mapping(t)) == {"channel_mapping": (1, 3)}


def test_rules_between_tables(t):
    assert check(quality.orders_vs_purchases(t)) == {"orders_vs_purchases": (1, 2)}
    one_each = t.customers.where("signup_date is not null")
    assert check(quality.source_matches_channel(t.ga4_events, one_each)) == {"source_matches_channel": (3, 5)}


def test_distributions(t):
    assert check(quality.funnel_shape(t)) == {"funnel_shape": (1, 3)}  # 2 page views, 2 item views, 1 purchase
    assert check(quality.variant_balance(t)) == {"variant_balance:x": (20, 40)}


def test_absent_cells_of_the_grid_are_bad(make):
    cells = [(5, "a"), (6, "a"), (5, "b"), (5, None), (6, None), (6, None)]
    spend = [{"spend_id": i, "spend_date": date(2026, 1, d), "channel": "Google Ads", "campaign_name": c} for i, (d, c) in enumerate(cells)]
    assert check(quality.spend_grid(make(marketing_spend=spend))) == {"spend_grid": (2, 6)}  # (6, b) absent, (6, none) doubled
    assert check(quality.spend_grid(make())) == {"spend_grid": (0, 0)}


def test_report_stacks_checks(t):
    both = quality.report(quality.spend_grid(t), quality.order_total(t.orders))
    assert set(check(both)) == {"spend_grid", "order_total"}


def test_empty_table_has_no_bad_rows(make):
    empty = make()
    assert check(quality.click_implies_open(empty)) == {"click_implies_open": (0, 0)}
    assert check(quality.primary_key(empty.orders, "orders", "order_id")) == {"primary_key:orders.order_id": (0, 0)}
