"""ANSI SQL answers to the queries of ``larkspur.catalog``, for checking them with DuckDB over the same files.

The texts are written on their own, not generated from the Spark plans: month counts come from ``age``, retention from
a self-join, ranks and running totals from plain windows, and rounded ratios from integer arithmetic.
"""

from __future__ import annotations

from larkspur.sources.star import view_prefix

AS_OF = "DATE '2001-12-31'"
BUYER_COUNTRY = "NATION_7"
MIN_ORDERS = 2990
REPORT_YEAR = 2000


def half_up(part: str, whole: str, places: int) -> str:
    """``part / whole`` for non-negative integers, rounded half up to ``places``; NULL when ``whole`` is 0."""
    unit = 10**places
    return f"((2*({part})*{unit} + ({whole})) // nullif(2*({whole}), 0)) / {unit}.0"


def pct(part: str, whole: str, places: int) -> str:
    return half_up(f"100*({part})", whole, places)


def cents(amount: str) -> str:
    return f"CAST(({amount})*100 AS HUGEINT)"


def text(views: str, body: str, *steps: str) -> str:
    """A query over the named views (blank-separated), with further named steps before the body."""
    return ",\n".join([view_prefix(*views.split()), *steps]) + "\n" + body


def months(start: str, end: str) -> str:
    return f"(extract(year FROM age({end}, {start}))*12 + extract(month FROM age({end}, {start})))"


def line(check: str, bad: str, source: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", CAST(coalesce(sum(CASE WHEN {bad} THEN 1 ELSE 0 END), 0) AS BIGINT) AS bad_rows,"
        f" count(*) AS total_rows FROM {source}"
    )


PAID = "('Google', 'Meta')"
STAGE = (
    "CASE event_name WHEN 'page_view' THEN 1 WHEN 'view_item' THEN 2 WHEN 'add_to_cart' THEN 3"
    " WHEN 'begin_checkout' THEN 4 WHEN 'purchase' THEN 5 END"
)
CLEAN = "CASE channel WHEN 'Google Ads' THEN 'Google' WHEN 'Meta Ads' THEN 'Meta' END"
BUYERS = "paid_for AS (SELECT customer_id, sum(total_amount) AS amount FROM g_orders WHERE order_status='completed' GROUP BY 1)"
WORTH = f"""{BUYERS},
runs AS (SELECT customer_id, mrr, start_date AS s, coalesce(end_date, {AS_OF}) AS e FROM g_subscriptions),
billed AS (SELECT customer_id, sum(mrr*CAST(greatest({months('s', 'e')}, 1) AS INT)) AS amount FROM runs GROUP BY 1),
worth AS (SELECT p.customer_id, p.acquisition_channel AS channel, p.signup_date, o.amount AS bought, b.amount AS billed,
  coalesce(o.amount, 0) + coalesce(b.amount, 0) AS total_ltv
  FROM g_customers p LEFT JOIN paid_for o ON o.customer_id=p.customer_id LEFT JOIN billed b ON b.customer_id=p.customer_id)"""
SPENT = f"spent AS (SELECT {CLEAN} AS channel, sum(cost) AS spend FROM g_marketing_spend GROUP BY 1)"
SPENT_Y = f"spent AS (SELECT year(spend_date) AS y, {CLEAN} AS channel, sum(cost) AS spend FROM g_marketing_spend GROUP BY 1, 2)"
WON = f"won AS (SELECT acquisition_channel AS channel, count(*) AS n FROM g_customers WHERE acquisition_channel IN {PAID} GROUP BY 1)"
FUNNEL = f"funnel AS (SELECT event_name, count(*) AS n, {STAGE} AS stage FROM g_ga4_events GROUP BY event_name)"
FUNNEL_Y = f"funnel AS (SELECT year(event_date) AS y, event_name, count(*) AS n, {STAGE} AS stage FROM g_ga4_events GROUP BY 1, 2)"
BROWSE = f"""browse AS (SELECT customer_id, sum(CASE WHEN event_name='page_view' THEN 1 ELSE 0 END) AS pv,
  sum(CASE WHEN event_name='view_item' THEN 1 ELSE 0 END) AS vi, count(DISTINCT session_id) AS sessions,
  {pct("sum(CASE WHEN device_category='mobile' THEN 1 ELSE 0 END)", "count(*)", 1)} AS mobile
  FROM g_ga4_events WHERE event_name IN ('page_view', 'view_item') GROUP BY customer_id)"""
MESSAGES = """messages AS (SELECT customer_id, count(*) AS sent, sum(CASE WHEN opened THEN 1 ELSE 0 END) AS opened,
  sum(CASE WHEN clicked THEN 1 ELSE 0 END) AS clicked FROM g_crm_engagement GROUP BY customer_id)"""
ACTIVE = """active AS (SELECT customer_id, count(*) AS events, count(DISTINCT event_date) AS days
  FROM g_ga4_events GROUP BY customer_id)"""
MESSAGE_COLUMNS = """CAST(coalesce(m.sent, 0) AS BIGINT) AS crm_emails_sent,
  CAST(coalesce(m.opened, 0) AS BIGINT) AS crm_emails_opened, CAST(coalesce(m.clicked, 0) AS BIGINT) AS crm_emails_clicked"""
CHURN = f"""churn AS (SELECT s.customer_id, s.plan_name, CAST({months("s.start_date", f"coalesce(s.end_date, {AS_OF})")} AS BIGINT)
  AS tenure_months, CAST(s.mrr AS DOUBLE) AS mrr, coalesce(a.events, 0) AS total_events, coalesce(a.days, 0) AS active_days,
  {MESSAGE_COLUMNS}, CAST(CASE WHEN c.customer_type='both' THEN 1 ELSE 0 END AS BIGINT) AS also_ecommerce, s.status
  FROM g_subscriptions s JOIN g_customers c ON c.customer_id=s.customer_id
  LEFT JOIN active a ON a.customer_id=s.customer_id LEFT JOIN messages m ON m.customer_id=s.customer_id)"""
RATE = "CAST(active_days AS DOUBLE) / CASE tenure_months WHEN 0 THEN 1 ELSE tenure_months END AS engagement_rate"
CHURNED = "CAST(CASE status WHEN 'cancelled' THEN 1 ELSE 0 END AS BIGINT) AS churned"
CHURN_VIEWS, CHURN_STEPS = "customers subscriptions ga4_events crm_engagement", (ACTIVE, MESSAGES, CHURN)
PEOPLE = f"""people AS (SELECT c.customer_id, c.acquisition_channel, c.country, c.customer_type,
  CAST({months("c.signup_date", AS_OF)} AS BIGINT) AS account_age_months, CAST(coalesce(b.pv, 0) AS BIGINT) AS page_views,
  CAST(coalesce(b.vi, 0) AS BIGINT) AS view_item_events, CAST(coalesce(b.sessions, 0) AS BIGINT) AS distinct_sessions,
  coalesce(b.mobile, 0.0) AS mobile_session_pct, {MESSAGE_COLUMNS}
  FROM g_customers c LEFT JOIN browse b ON b.customer_id=c.customer_id LEFT JOIN messages m ON m.customer_id=c.customer_id)"""
PEOPLE_VIEWS, PEOPLE_STEPS = "customers ga4_events crm_engagement orders subscriptions", (BROWSE, MESSAGES, PEOPLE)
HAS_BOUGHT = "has_bought AS (SELECT DISTINCT customer_id FROM g_orders WHERE order_status='completed')"
HELD_OUT = "(substr(md5(concat(CAST(customer_id AS VARCHAR), '-42')), 1, 4) < '3333')"
# A fifth of the customers of each class, by hash; a customer is as churned as any of their subscriptions.
SHARES = (
    """classed AS (SELECT customer_id, max(CASE status WHEN 'cancelled' THEN 1 ELSE 0 END) AS label
  FROM churn WHERE status<>'paused' GROUP BY 1)""",
    """sides AS (SELECT customer_id, row_number() OVER (PARTITION BY label
    ORDER BY md5(concat(CAST(customer_id AS VARCHAR), '-42')), customer_id)
  <= round(0.2 * count(*) OVER (PARTITION BY label)) AS is_test FROM classed)""",
)
GUESS = """guess AS (SELECT CAST(CASE WHEN b.customer_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS label,
  CAST(CASE WHEN s.purchase_propensity_score >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS prediction
  FROM g_customer_scores s LEFT JOIN has_bought b ON b.customer_id=s.customer_id)"""


def band(score: str, low: str, medium: str, high: str, none: str = "NULL") -> str:
    return f"CASE WHEN {score} >= 0.5 THEN '{high}' WHEN {score} >= 0.3 THEN '{medium}' WHEN {score} IS NOT NULL THEN '{low}' ELSE {none} END"


CHURN_BAND = band("s.churn_risk_score", "Low Risk", "Medium Risk", "High Risk")
PROPENSITY = band("s.purchase_propensity_score", "Low", "Medium", "High", "'Low'")
MEAN_LTV = half_up(cents("sum(s.predicted_ltv)"), "100*count(s.predicted_ltv)", 2)
CHURN_Y = f"""bands AS (SELECT year(c.signup_date) AS y, {CHURN_BAND} AS band, count(*) AS n, {MEAN_LTV} AS ltv
  FROM g_customers c JOIN g_customer_scores s ON s.customer_id=c.customer_id WHERE s.churn_risk_score IS NOT NULL GROUP BY 1, 2)"""
PROPENSITY_Y = f"""bands AS (SELECT year(c.signup_date) AS y, {PROPENSITY} AS band, count(*) AS n
  FROM g_customers c JOIN g_customer_scores s ON s.customer_id=c.customer_id GROUP BY 1, 2)"""


def visits(source: str, day: str, grain: str) -> tuple[str, str]:
    """Steps ``seen`` (customer, period) and ``kept`` (period, active, retained)."""
    start = f"CAST(date_trunc('{grain}', {day}) AS DATE)"
    seen = f"seen AS (SELECT DISTINCT customer_id, {start} AS p FROM {source})"
    kept = f"""kept AS (SELECT a.p, count(DISTINCT a.customer_id) AS active, count(DISTINCT b.customer_id) AS again
  FROM seen a LEFT JOIN seen b ON b.customer_id=a.customer_id AND b.p = CAST(a.p + INTERVAL '1 {grain}' AS DATE) GROUP BY a.p)"""
    return seen, kept


RETAINED = f"active AS active_customers, again AS retained_next_month, {pct('again', 'active', 1)} AS retention_rate_pct"


def retention_sql(source: str, day: str, grain: str) -> str:
    return text(source, f"SELECT p AS activity_month, {RETAINED} FROM kept", *visits(f"g_{source}", day, grain))


AB = "count(*) AS total_assigned, CAST(sum(CASE WHEN converted THEN 1 ELSE 0 END) AS BIGINT) AS total_converted"
AB_RATE = f"{AB}, {pct('sum(CASE WHEN converted THEN 1 ELSE 0 END)', 'count(*)', 2)} AS conversion_rate_pct"
AB_CELLS = """cells AS (SELECT CAST(sum(CASE WHEN variant='A' THEN 1 ELSE 0 END) AS DOUBLE) AS na,
  CAST(sum(CASE WHEN variant='B' THEN 1 ELSE 0 END) AS DOUBLE) AS nb,
  CAST(sum(CASE WHEN variant='A' AND converted THEN 1 ELSE 0 END) AS DOUBLE) AS ca,
  CAST(sum(CASE WHEN variant='B' AND converted THEN 1 ELSE 0 END) AS DOUBLE) AS cb FROM g_ab_test_assignments)"""
AB_Z = """zed AS (SELECT ca/na AS pa, cb/nb AS pb,
  (ca/na - cb/nb) / sqrt((ca+cb)/(na+nb) * (1 - (ca+cb)/(na+nb)) * (1/na + 1/nb)) AS z FROM cells)"""

PERFORMANCE = f"""perf AS (SELECT s.channel, s.spend, v.n, {half_up(cents("s.spend"), "100*v.n", 2)} AS cac, v.revenue,
  {half_up(cents("v.revenue"), cents("s.spend"), 2)} AS roas, {half_up(cents("v.value"), "100*v.n", 2)} AS ltv,
  {half_up(cents("v.value"), cents("s.spend"), 2)} AS ltv_cac
  FROM spent s JOIN (SELECT channel, count(*) AS n, sum(total_ltv) AS value, sum(bought) AS revenue FROM worth
    WHERE channel IN {PAID} GROUP BY channel) v ON v.channel=s.channel WHERE v.revenue IS NOT NULL)"""
PERFORMANCE_Y = f"""perf AS (SELECT v.y, v.channel, s.spend, v.n, {half_up(cents("s.spend"), "100*v.n", 2)} AS cac, v.revenue,
  {half_up(cents("v.revenue"), cents("s.spend"), 2)} AS roas, {half_up(cents("v.value"), "100*v.n", 2)} AS ltv,
  {half_up(cents("v.value"), cents("s.spend"), 2)} AS ltv_cac
  FROM (SELECT year(signup_date) AS y, channel, count(*) AS n, sum(total_ltv) AS value, sum(bought) AS revenue FROM worth
    WHERE channel IN {PAID} GROUP BY 1, 2) v LEFT JOIN spent s ON s.y=v.y AND s.channel=v.channel)"""
PERFORMANCE_COLUMNS = """channel, CAST(spend AS DOUBLE) AS total_spend, n AS new_customers, cac,
  CAST(revenue AS DOUBLE) AS total_revenue, roas, ltv AS avg_ltv, ltv_cac AS ltv_to_cac_ratio"""
VALUE_VIEWS = "customers orders subscriptions marketing_spend"
SHARE = pct("n", "sum(n) OVER ()", 0)
KPIS = f"""SELECT (SELECT count(*) FROM g_customers c {{where}}) AS customers, CAST(sum(round(ltv*100)*n) AS HUGEINT)/100.0 AS total_ltv,
  {half_up("CAST(sum(round(ltv*100)*n) AS HUGEINT)", "100*CAST(sum(n) AS HUGEINT)", 6)} AS avg_ltv, max(ltv_cac) AS best_ratio,
  (SELECT channel FROM perf {{perf}} ORDER BY ltv_cac DESC, channel LIMIT 1) AS best_channel FROM perf {{perf}}"""


def _one_hot() -> str:
    levels = {
        "acquisition_channel": ["Email", "Google", "Meta", "Organic", "Referral"],
        "country": sorted(f"NATION_{i}" for i in range(25))[1:],
        "customer_type": ["ecommerce", "saas"],
    }
    dummies = [
        f"CAST(CASE WHEN {c}='{v}' THEN 1 ELSE 0 END AS BIGINT) AS \"{c}_{v}\"" for c, vs in levels.items() for v in vs
    ]
    return text("customers", f"SELECT customer_id, {', '.join(dummies)} FROM g_customers")


def _quality() -> dict[str, str]:
    def key(table: str, column: str) -> str:
        return (
            f"SELECT 'primary_key:{table}.{column}' AS \"check\", count(*) - count(DISTINCT {column}) AS bad_rows,"
            f" count(*) AS total_rows FROM g_{table}"
        )

    def parent(table: str) -> str:
        bad = "x.customer_id IS NOT NULL AND c.customer_id IS NULL"
        source = f"g_{table} x LEFT JOIN g_customers c ON c.customer_id=x.customer_id"
        return line(f"foreign_key:{table}.customer_id", bad, source)

    def filled(table: str, *columns: str) -> list[str]:
        return [line(f"not_null:{table}.{c}", f"{c} IS NULL", f"g_{table}") for c in columns]

    def among(table: str, column: str, *values: str) -> str:
        listed = ", ".join(f"'{v}'" for v in values)
        return line(f"domain:{table}.{column}", f"{column} NOT IN ({listed})", f"g_{table}")

    def stack(views: str, lines: list[str]) -> str:
        return text(views, "\nUNION ALL ".join(lines))

    return {
        "dq_primary_key": stack(
            "customers marketing_spend ga4_events orders subscriptions crm_engagement ab_test_assignments customer_scores",
            [
                key("customers", "customer_id"),
                key("marketing_spend", "spend_id"),
                key("crm_engagement", "engagement_id"),
                key("ga4_events", "event_id"),
                key("orders", "order_id"),
                key("subscriptions", "subscription_id"),
                key("ab_test_assignments", "assignment_id"),
                key("customer_scores", "customer_id"),
            ],
        ),
        "dq_foreign_key": stack(
            "customers ga4_events orders subscriptions crm_engagement ab_test_assignments customer_scores",
            [
                parent(x)
                for x in ("ga4_events", "orders", "subscriptions", "crm_engagement", "ab_test_assignments", "customer_scores")
            ],
        ),
        "dq_not_null": stack(
            "customers marketing_spend ga4_events orders subscriptions crm_engagement ab_test_assignments customer_scores",
            [
                *filled("customers", "customer_id", "signup_date"),
                *filled("marketing_spend", "spend_id", "spend_date", "channel"),
                *filled("ga4_events", "event_id", "event_date"),
                *filled("orders", "order_id", "order_date"),
                *filled("subscriptions", "subscription_id", "start_date"),
                *filled("crm_engagement", "engagement_id", "sent_date"),
                *filled("ab_test_assignments", "assignment_id", "assigned_date"),
                *filled("customer_scores", "customer_id", "scored_at"),
            ],
        ),
        "dq_domain": stack(
            "customers marketing_spend ga4_events orders subscriptions crm_engagement ab_test_assignments",
            [
                among("customers", "acquisition_channel", "Google", "Meta", "Organic", "Referral", "Direct", "Email"),
                among("customers", "country", "United States", "United Kingdom", "Nigeria", "Canada", "Germany", "India"),
                among("customers", "customer_type", "ecommerce", "saas", "both"),
                among("marketing_spend", "channel", "Google Ads", "Meta Ads"),
                among("ga4_events", "event_name", "page_view", "view_item", "add_to_cart", "begin_checkout", "purchase"),
                among("ga4_events", "device_category", "desktop", "mobile", "tablet"),
                among("orders", "product_name", "Starter Kit", "Pro Bundle", "Premium Set", "Accessory Pack", "Gift Card"),
                among("orders", "order_status", "completed", "refunded", "cancelled"),
                among("subscriptions", "plan_name", "Basic", "Pro", "Enterprise"),
                among("subscriptions", "status", "active", "cancelled", "paused"),
                among("crm_engagement", "campaign_name", "Welcome Series", "Cart Abandonment", "Weekly Newsletter",
                      "Win-Back", "Product Announcement"),
                among("crm_engagement", "channel", "email", "push", "sms"),
                among("ab_test_assignments", "variant", "A", "B"),
            ],
        ),
        "dq_funnel_shape": text(
            "ga4_events",
            line("funnel_shape", "n >= before", "(SELECT n, lag(n) OVER (ORDER BY stage) AS before FROM funnel WHERE stage IS NOT NULL) f"),
            FUNNEL,
        ),
        "dq_click_implies_open": text("crm_engagement", line("click_implies_open", "clicked AND NOT coalesce(opened, FALSE)", "g_crm_engagement")),
        "dq_order_total": text(
            "orders",
            line("order_total", "c <> (c // quantity)*quantity",
                 "(SELECT CAST(total_amount*100 AS BIGINT) AS c, quantity FROM g_orders) o"),
        ),
        "dq_orders_vs_purchases": text(
            "orders ga4_events",
            line("orders_vs_purchases", "o.n IS DISTINCT FROM e.n",
                 """(SELECT customer_id, order_date AS d, count(*) AS n FROM g_orders WHERE customer_id IS NOT NULL GROUP BY 1, 2) o
  FULL JOIN (SELECT customer_id, event_date AS d, count(*) AS n FROM g_ga4_events
    WHERE event_name='purchase' AND customer_id IS NOT NULL GROUP BY 1, 2) e ON e.customer_id=o.customer_id AND e.d=o.d"""),
        ),
        "dq_end_date_status": text(
            "subscriptions",
            line("end_date_status", f"((end_date IS NULL) <> (status='active')) OR coalesce(end_date > {AS_OF}, FALSE)", "g_subscriptions"),
        ),
        "dq_spend_grid": text(
            "marketing_spend",
            """SELECT 'spend_grid' AS "check", CAST(sum(CASE WHEN n IS NULL OR n <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS bad_rows,
  count(*) AS total_rows
FROM (SELECT DISTINCT spend_date FROM g_marketing_spend) d
CROSS JOIN (SELECT DISTINCT channel, campaign_name FROM g_marketing_spend) p
LEFT JOIN (SELECT spend_date, channel, campaign_name, count(*) AS n FROM g_marketing_spend GROUP BY 1, 2, 3) cells
  USING (spend_date, channel, campaign_name)""",
        ),
        "dq_channel_mapping": text("marketing_spend", line("channel_mapping", f"{CLEAN} IS NULL", "g_marketing_spend")),
        "dq_source_matches_channel": text(
            "customers ga4_events",
            line("source_matches_channel", "e.source IS DISTINCT FROM lower(c.acquisition_channel)",
                 """(SELECT customer_id, CASE device_category WHEN 'desktop' THEN 'google' WHEN 'mobile' THEN 'meta' ELSE 'organic' END
    AS source FROM g_ga4_events) e LEFT JOIN g_customers c ON c.customer_id=e.customer_id"""),
        ),
        "dq_variant_balance": text(
            "ab_test_assignments",
            """SELECT concat('variant_balance:', experiment_name) AS "check",
  CAST(CASE WHEN abs(a-b)/2.0 > 1.5*sqrt(n) THEN floor(abs(a-b)/2.0) ELSE 0 END AS BIGINT) AS bad_rows, n AS total_rows
FROM (SELECT experiment_name, sum(CASE WHEN variant='A' THEN 1 ELSE 0 END) AS a,
  sum(CASE WHEN variant='B' THEN 1 ELSE 0 END) AS b, count(*) AS n FROM g_ab_test_assignments GROUP BY 1) v""",
        ),
    }


ORACLES: dict[str, str] = {
    # sources
    "src_table": text("customers", "SELECT * FROM g_customers"),
    "row_count": text("customers", "SELECT count(*) AS row_count FROM g_customers"),
    "preview": text("customers", "SELECT * FROM g_customers ORDER BY customer_id LIMIT 10"),
    "full_table": text("orders", "SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount, CAST(quantity AS BIGINT) AS quantity) FROM g_orders"),
    "assign_ids": text(
        "ga4_events",
        "SELECT event_id, row_number() OVER (ORDER BY substr(md5(CAST(event_id AS VARCHAR)), 1, 4), event_id) AS id FROM g_ga4_events",
    ),
    **{
        name: text("customers", "SELECT * FROM g_customers")
        for name in ("sink_csv", "sink_json", "bulk_append", "load_once_guard")
    },
    "full_refresh": text(
        "customer_scores",
        """SELECT customer_id, CAST(churn_risk_score AS DOUBLE) AS churn_risk_score,
  CAST(purchase_propensity_score AS DOUBLE) AS purchase_propensity_score, CAST(predicted_ltv AS DOUBLE) AS predicted_ltv
FROM g_customer_scores""",
    ),
    "truncate_reset": "SELECT CAST(0 AS BIGINT) AS row_count",
    # filters
    "recent_completed_orders": text(
        "orders",
        """SELECT order_id, customer_id, order_date, product_name, CAST(total_amount AS DOUBLE) AS total_amount FROM g_orders
WHERE order_status='completed' ORDER BY order_date DESC, order_id LIMIT 10""",
    ),
    "mobile_purchases": text(
        "ga4_events",
        "SELECT * FROM g_ga4_events WHERE device_category='mobile' AND event_name='purchase' ORDER BY event_date, event_id LIMIT 15",
    ),
    "top_churn_risk": text(
        "customer_scores",
        """SELECT customer_id, CAST(churn_risk_score AS DOUBLE) AS churn_risk_score,
  CAST(purchase_propensity_score AS DOUBLE) AS purchase_propensity_score, CAST(predicted_ltv AS DOUBLE) AS predicted_ltv,
  scored_at
FROM g_customer_scores s ORDER BY s.churn_risk_score DESC NULLS LAST, customer_id LIMIT 10""",
    ),
    "checkout_eligible_customers": text(
        "ga4_events", "SELECT customer_id FROM g_ga4_events WHERE event_name='begin_checkout' AND customer_id IS NOT NULL GROUP BY 1"
    ),
    "saas_eligible_customers": text("customers", "SELECT customer_id, signup_date FROM g_customers WHERE customer_type<>'ecommerce'"),
    "purchase_events": text("ga4_events", "SELECT customer_id, event_date FROM g_ga4_events WHERE event_name='purchase'"),
    "monthly_activity": text(
        "ga4_events", "SELECT customer_id, CAST(date_trunc('month', event_date) AS DATE) AS activity_month FROM g_ga4_events GROUP BY 1, 2"
    ),
    "monthly_activity_head": text(
        "ga4_events",
        "SELECT customer_id, CAST(date_trunc('month', event_date) AS DATE) AS activity_month FROM g_ga4_events GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 20",
    ),
    "customer_channel_dates": text("customers", "SELECT customer_id, acquisition_channel, signup_date FROM g_customers"),
    "customer_signup_dates": text("customers", "SELECT customer_id, signup_date FROM g_customers"),
    # joins
    "completed_orders_with_country": text(
        "customers orders",
        """SELECT o.customer_id, p.country, o.order_date, CAST(o.total_amount AS DOUBLE) AS total_amount
FROM g_orders o JOIN g_customers p ON p.customer_id=o.customer_id AND o.order_status='completed'""",
    ),
    "revenue_by_country": text(
        "customers orders",
        """SELECT count(*) AS distinct_customers, country, CAST(sum(amount) AS DOUBLE) AS total_revenue
FROM paid_for JOIN g_customers USING (customer_id) GROUP BY country""",
        BUYERS,
    ),
    "total_spend_all_customers": text(
        "customers orders",
        "SELECT p.customer_id, p.country, CAST(b.amount AS DOUBLE) AS total_spend FROM g_customers p LEFT JOIN paid_for b ON b.customer_id=p.customer_id",
        BUYERS,
    ),
    "country_buyers_semi": text(
        "customers orders",
        f"""SELECT p.customer_id, p.country FROM g_customers p WHERE p.country='{BUYER_COUNTRY}' AND EXISTS
  (SELECT 1 FROM g_orders o WHERE o.customer_id=p.customer_id AND o.order_status='completed')""",
    ),
    "country_buyers_cte": text(
        "customers orders",
        f"SELECT customer_id, country FROM g_customers JOIN has_bought USING (customer_id) WHERE country='{BUYER_COUNTRY}'",
        HAS_BOUGHT,
    ),
    "avg_buyer_spend_by_channel": text(
        "customers orders",
        f"""SELECT acquisition_channel, {half_up(cents("sum(amount)"), "100*count(*)", 6)} AS avg_spend_per_customer
FROM paid_for JOIN g_customers USING (customer_id) GROUP BY acquisition_channel""",
        BUYERS,
    ),
    "retention_selfjoin": retention_sql("orders", "order_date", "month"),
    "combine_scores": text(
        "customer_scores",
        """SELECT customer_id, CAST(churn_risk_score AS DOUBLE) AS churn_risk_score,
  CAST(purchase_propensity_score AS DOUBLE) AS purchase_propensity_score, CAST(predicted_ltv AS DOUBLE) AS predicted_ltv,
  TIMESTAMP '2001-12-31 00:00:00' AS scored_at FROM g_customer_scores""",
    ),
    "feature_left_joins": text(
        "customers ga4_events crm_engagement",
        f"""SELECT c.customer_id, coalesce(a.events, 0) AS total_events, coalesce(a.days, 0) AS active_days, {MESSAGE_COLUMNS}
FROM g_customers c LEFT JOIN active a ON a.customer_id=c.customer_id LEFT JOIN messages m ON m.customer_id=c.customer_id""",
        ACTIVE,
        MESSAGES,
    ),
    "cohort_left_joins": text(
        "customers marketing_spend",
        f"""SELECT w.y AS year, w.channel, w.n AS new_customers, CAST(s.spend AS DOUBLE) AS total_spend
FROM (SELECT year(signup_date) AS y, acquisition_channel AS channel, count(*) AS n FROM g_customers
  WHERE acquisition_channel IN {PAID} GROUP BY 1, 2) w LEFT JOIN spent s ON s.y=w.y AND s.channel=w.channel""",
        SPENT_Y,
    ),
    # aggregates
    "channel_totals": text(
        "marketing_spend",
        "SELECT channel, CAST(sum(cost) AS DOUBLE) AS total_cost, CAST(sum(conversions) AS BIGINT) AS total_conversions FROM g_marketing_spend GROUP BY 1",
    ),
    "popular_products": text(
        "orders",
        f"""SELECT product_name, n AS order_count, {half_up(cents("amount"), "100*n", 6)} AS avg_total_amt
FROM (SELECT product_name, count(*) AS n, sum(total_amount) AS amount FROM g_orders GROUP BY 1) p WHERE n > {MIN_ORDERS}""",
    ),
    "customers_by_country": text("customers", "SELECT country, count(*) AS num_customers FROM g_customers GROUP BY 1"),
    "event_counts": text("ga4_events", "SELECT event_name, count(*) AS event_count FROM g_ga4_events GROUP BY 1"),
    "variant_counts": text("ab_test_assignments", f"SELECT variant, {AB} FROM g_ab_test_assignments GROUP BY 1"),
    "ab_conversion": text("ab_test_assignments", f"SELECT variant, {AB_RATE} FROM g_ab_test_assignments GROUP BY 1"),
    "ab_conversion_by_year": text(
        "ab_test_assignments", f"SELECT year(assigned_date) AS year, variant, {AB_RATE} FROM g_ab_test_assignments GROUP BY 1, 2"
    ),
    "customer_growth": text(
        "customers",
        """SELECT year(signup_date) AS year, strftime(signup_date, '%b') AS month, month(signup_date) AS month_num,
  count(*) AS customers FROM g_customers GROUP BY 1, 2, 3""",
    ),
    "spend_trend_by_channel": text(
        "marketing_spend",
        f"""SELECT year(spend_date) AS year, strftime(spend_date, '%b') AS month, month(spend_date) AS month_num,
  {CLEAN} AS channel, CAST(sum(cost) AS DOUBLE) AS spend, CAST(sum(conversions) AS BIGINT) AS conversions
FROM g_marketing_spend GROUP BY 1, 2, 3, g_marketing_spend.channel""",
    ),
    "spend_trend_monthly": text(
        "marketing_spend",
        f"""SELECT strftime(spend_date, '%Y-%m') AS year_month, CAST(date_trunc('month', spend_date) AS DATE) AS month_sort,
  {CLEAN} AS channel_clean, CAST(sum(cost) AS DOUBLE) AS daily_cost, CAST(sum(clicks) AS BIGINT) AS daily_clicks,
  CAST(sum(impressions) AS BIGINT) AS daily_impressions, CAST(sum(conversions) AS BIGINT) AS daily_conversions
FROM g_marketing_spend GROUP BY 1, 2, 3""",
    ),
    "customer_breakdown": text(
        "customers", "SELECT acquisition_channel, country, customer_type, count(*) AS customer_count FROM g_customers GROUP BY 1, 2, 3"
    ),
    "funnel_by_year": text(
        "ga4_events", "SELECT y AS year, event_name, n AS event_count, CAST(stage AS BIGINT) AS stage_order FROM funnel", FUNNEL_Y
    ),
    "funnel_all_time": text(
        "ga4_events", "SELECT event_name, n AS event_count, CAST(stage AS BIGINT) AS stage_order FROM funnel", FUNNEL
    ),
    "risk_propensity_bands": text(
        "customer_scores",
        f"""SELECT coalesce({CHURN_BAND}, 'N/A (not subscriber)') AS churn_risk_band, concat({PROPENSITY}, ' Propensity') AS propensity_band,
  count(*) AS customer_count, {MEAN_LTV} AS avg_predicted_ltv FROM g_customer_scores s GROUP BY 1, 2""",
    ),
    "churn_bands_by_year": text(
        "customers customer_scores",
        "SELECT y AS year, band AS churn_risk_band, n AS customer_count, ltv AS avg_predicted_ltv FROM bands",
        CHURN_Y,
    ),
    "propensity_bands_by_year": text(
        "customers customer_scores", "SELECT y AS year, band AS propensity_band, n AS customer_count FROM bands", PROPENSITY_Y
    ),
    "conditional_counts": text(
        "ga4_events",
        """SELECT customer_id, CAST(pv AS BIGINT) AS page_views, CAST(vi AS BIGINT) AS view_item_events,
  sessions AS distinct_sessions, mobile AS mobile_session_pct FROM browse""",
        BROWSE,
    ),
    "engagement_counts": text(
        "ga4_events crm_engagement",
        """SELECT coalesce(a.customer_id, m.customer_id) AS customer_id, events AS total_events, days AS active_days,
  sent AS total_sent, CAST(opened AS BIGINT) AS total_opened, CAST(clicked AS BIGINT) AS total_clicked
FROM active a FULL JOIN messages m ON m.customer_id=a.customer_id""",
        ACTIVE,
        MESSAGES,
    ),
    "target_summary": text(
        VALUE_VIEWS,
        """SELECT count(*) AS "count", round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, min(v) AS min,
  round(quantile_cont(v, 0.25), 4) AS p25, round(quantile_cont(v, 0.5), 4) AS p50, round(quantile_cont(v, 0.75), 4) AS p75,
  max(v) AS max FROM (SELECT CAST(total_ltv AS DOUBLE) AS v FROM worth) w""",
        WORTH,
    ),
    "class_rate": text(
        CHURN_VIEWS,
        f"""SELECT part, CAST(sum(n) AS BIGINT) AS n, CAST(sum(bad) AS BIGINT) AS positives, {pct("sum(bad)", "sum(n)", 1)} AS positive_pct
FROM (SELECT 'all' AS part, is_test, n, bad FROM halves UNION ALL
  SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END, is_test, n, bad FROM halves) u GROUP BY part""",
        *CHURN_STEPS,
        *SHARES,
        """halves AS (SELECT is_test, count(*) AS n, sum(CASE status WHEN 'cancelled' THEN 1 ELSE 0 END) AS bad
  FROM churn JOIN sides USING (customer_id) WHERE status<>'paused' GROUP BY 1)""",
    ),
    # windows
    "spend_rank_in_country": text(
        "customers orders",
        """SELECT customer_id, country, CAST(amount AS DOUBLE) AS total_spend,
  rank() OVER (PARTITION BY country ORDER BY amount DESC) AS spend_rank FROM paid_for JOIN g_customers USING (customer_id)""",
        BUYERS,
    ),
    "running_channel_cost": text(
        "marketing_spend",
        """SELECT spend_date, channel, CAST(cost AS DOUBLE) AS cost,
  CAST(sum(cost) OVER (PARTITION BY channel ORDER BY spend_date) AS DOUBLE) AS running_total_cost FROM g_marketing_spend""",
    ),
    "funnel_stage_lag": text(
        "ga4_events",
        f"""SELECT event_name, n AS event_count, before AS previous_stage_count, {pct("n", "before", 1)} AS pct_of_previous_stage
FROM (SELECT event_name, n, lag(n) OVER (ORDER BY stage NULLS LAST, event_name) AS before FROM funnel) f""",
        FUNNEL,
    ),
    "funnel_conversion": text(
        "ga4_events",
        f"""SELECT event_name, n AS event_count, {pct("n", "top", 1)} AS pct_of_total, {pct("n", "before", 1)} AS pct_of_previous_stage
FROM (SELECT event_name, n, lag(n) OVER w AS before, first_value(n) OVER w AS top FROM funnel
  WINDOW w AS (ORDER BY stage NULLS LAST, event_name)) f""",
        FUNNEL,
    ),
    # metrics
    "channel_clean": text(
        "marketing_spend", f"SELECT channel, {CLEAN} AS channel_clean, count(*) AS spend_rows FROM g_marketing_spend GROUP BY g_marketing_spend.channel"
    ),
    "cac_by_channel": text(
        "customers marketing_spend",
        f"""SELECT s.channel AS channel_clean, CAST(s.spend AS DOUBLE) AS total_spend, w.n AS new_customers,
  {half_up(cents("s.spend"), "100*w.n", 2)} AS cac FROM spent s JOIN won w ON w.channel=s.channel""",
        SPENT,
        WON,
    ),
    "roas_by_channel": text(
        VALUE_VIEWS,
        f"""SELECT s.channel AS channel_clean, CAST(s.spend AS DOUBLE) AS total_spend, CAST(r.revenue AS DOUBLE) AS total_revenue,
  {half_up(cents("r.revenue"), cents("s.spend"), 2)} AS roas FROM spent s JOIN (SELECT acquisition_channel AS channel,
  sum(amount) AS revenue FROM paid_for JOIN g_customers USING (customer_id) GROUP BY 1) r ON r.channel=s.channel""",
        BUYERS,
        SPENT,
    ),
    "retention_monthly": retention_sql("ga4_events", "event_date", "month"),
    "retention_orders_monthly": retention_sql("orders", "order_date", "month"),
    "retention_events_weekly": retention_sql("ga4_events", "event_date", "week"),
    "retention_events_daily": retention_sql("ga4_events", "event_date", "day"),
    "retention_curve": text(
        "orders", f"SELECT strftime(p, '%Y-%m') AS activity_month, {RETAINED} FROM kept", *visits("g_orders", "order_date", "month")
    ),
    "retention_by_year": text(
        "orders",
        f"SELECT year(p) AS year, strftime(p, '%b') AS month, month(p) AS month_num, {RETAINED} FROM kept",
        *visits("g_orders", "order_date", "month"),
    ),
    "customer_ltv": text(
        VALUE_VIEWS,
        """SELECT customer_id, channel AS acquisition_channel, CAST(coalesce(bought, 0) AS DOUBLE) AS ecommerce_ltv,
  CAST(coalesce(billed, 0) AS DOUBLE) AS saas_ltv, CAST(total_ltv AS DOUBLE) AS total_ltv FROM worth""",
        WORTH,
    ),
    "top_ltv_customers": text(
        VALUE_VIEWS,
        """SELECT customer_id, channel AS acquisition_channel, CAST(coalesce(bought, 0) AS DOUBLE) AS ecommerce_ltv,
  CAST(coalesce(billed, 0) AS DOUBLE) AS saas_ltv, CAST(total_ltv AS DOUBLE) AS total_ltv FROM worth w
ORDER BY w.total_ltv DESC, customer_id LIMIT 20""",
        WORTH,
    ),
    "ltv_to_cac": text(
        VALUE_VIEWS,
        f"""SELECT channel AS acquisition_channel, {half_up(cents("value"), "100*n", 2)} AS avg_ltv, cac,
  {half_up(cents("value"), "n*CAST(round(cac*100) AS HUGEINT)", 2)} AS ltv_to_cac_ratio
FROM (SELECT v.channel, v.n, v.value, {half_up(cents("s.spend"), "100*v.n", 2)} AS cac FROM spent s JOIN
  (SELECT channel, count(*) AS n, sum(total_ltv) AS value FROM worth WHERE channel IN {PAID} GROUP BY 1) v ON v.channel=s.channel) x""",
        WORTH,
        SPENT,
    ),
    "channel_performance": text(VALUE_VIEWS, f"SELECT {PERFORMANCE_COLUMNS} FROM perf", WORTH, SPENT, PERFORMANCE),
    "channel_performance_by_year": text(
        VALUE_VIEWS, f"SELECT y AS year, {PERFORMANCE_COLUMNS} FROM perf", WORTH, SPENT_Y, PERFORMANCE_Y
    ),
    # features
    "churn_features": text(
        CHURN_VIEWS, f"SELECT * EXCLUDE (status), {RATE}, {CHURNED} FROM churn WHERE status IN ('active', 'cancelled')", *CHURN_STEPS
    ),
    "churn_scoring_features": text(
        CHURN_VIEWS, f"SELECT * EXCLUDE (status), {RATE} FROM churn WHERE status='active'", *CHURN_STEPS
    ),
    "propensity_features": text(
        PEOPLE_VIEWS,
        """SELECT p.*, CAST(CASE WHEN b.customer_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS purchased
FROM people p LEFT JOIN has_bought b ON b.customer_id=p.customer_id""",
        *PEOPLE_STEPS,
        HAS_BOUGHT,
    ),
    "propensity_scoring_features": text(PEOPLE_VIEWS, "SELECT * FROM people", *PEOPLE_STEPS),
    "ltv_features": text(
        PEOPLE_VIEWS,
        "SELECT p.*, CAST(w.total_ltv AS DOUBLE) AS total_ltv FROM people p JOIN worth w ON w.customer_id=p.customer_id",
        *PEOPLE_STEPS,
        WORTH,
    ),
    "engagement_rate": text(
        CHURN_VIEWS,
        f"SELECT customer_id, tenure_months, active_days, {RATE} FROM churn WHERE status IN ('active', 'cancelled')",
        *CHURN_STEPS,
    ),
    "log_target": text(
        VALUE_VIEWS,
        """SELECT customer_id, CAST(total_ltv AS DOUBLE) AS total_ltv, round(ln(1 + CAST(total_ltv AS DOUBLE)), 6) AS log_ltv,
  CAST(total_ltv AS DOUBLE) AS back FROM worth""",
        WORTH,
    ),
    "one_hot_drop_first": _one_hot(),
    "one_hot_sparse": text(
        "customers",
        """SELECT customer_id, coalesce(string_agg(place::VARCHAR, ',' ORDER BY place), '') AS places
FROM said LEFT JOIN placed ON placed.col = said.col AND placed.level = said.level GROUP BY customer_id""",
        """said AS (SELECT customer_id, unnest([1, 2, 3]) AS col, unnest([acquisition_channel, country, customer_type]) AS level FROM g_customers)""",
        """firsts AS (SELECT col, min(level) AS least_level FROM said GROUP BY col)""",
        """placed AS (SELECT col, level, row_number() OVER (ORDER BY col, level) - 1 AS place
  FROM (SELECT DISTINCT said.col, level FROM said JOIN firsts ON firsts.col = said.col WHERE level > least_level) d)""",
    ),
    "align_features": text(
        "customers",
        """SELECT customer_id, CAST(CASE customer_type WHEN 'saas' THEN 1 ELSE 0 END AS BIGINT) AS customer_type_saas,
  CAST(0 AS BIGINT) AS customer_type_reseller, CAST(CASE customer_type WHEN 'ecommerce' THEN 1 ELSE 0 END AS BIGINT)
  AS customer_type_ecommerce FROM g_customers""",
    ),
    # splits, weights and metrics of fixed predictions
    "stratified_split": text(
        CHURN_VIEWS,
        f"SELECT customer_id, {CHURNED}, is_test FROM churn JOIN sides USING (customer_id) WHERE status<>'paused'",
        *CHURN_STEPS,
        *SHARES,
    ),
    "random_split": text(
        VALUE_VIEWS, f"SELECT customer_id, CAST(total_ltv AS DOUBLE) AS total_ltv, {HELD_OUT} AS is_test FROM worth", WORTH
    ),
    "class_weights": text(
        PEOPLE_VIEWS,
        """SELECT label AS purchased, n, round(CAST(sum(n) OVER () AS DOUBLE) / (count(*) OVER () * n), 6) AS weight
FROM (SELECT label, count(*) AS n FROM guess GROUP BY label) g""".replace("guess", "labels_of"),
        HAS_BOUGHT,
        """labels_of AS (SELECT CAST(CASE WHEN b.customer_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS label
  FROM g_customers c LEFT JOIN has_bought b ON b.customer_id=c.customer_id)""",
    ),
    "confusion_matrix": text(
        "customer_scores orders", "SELECT label, prediction, count(*) AS n FROM guess GROUP BY 1, 2", HAS_BOUGHT, GUESS
    ),
    "classification_report": text(
        "customer_scores orders",
        """SELECT '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, CAST(s0 AS BIGINT) AS support FROM m
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), CAST(s1 AS BIGINT) FROM m
UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), CAST(s0+s1 AS BIGINT) FROM m
UNION ALL SELECT 'macro avg', round((p0+p1)/2, 6), round((r0+r1)/2, 6), round((f0+f1)/2, 6), CAST(s0+s1 AS BIGINT) FROM m
UNION ALL SELECT 'weighted avg', round((p0*s0+p1*s1)/(s0+s1), 6), round((r0*s0+r1*s1)/(s0+s1), 6),
  round((f0*s0+f1*s1)/(s0+s1), 6), CAST(s0+s1 AS BIGINT) FROM m""",
        HAS_BOUGHT,
        GUESS,
        """c AS (SELECT CAST(sum(CASE WHEN label=1 AND prediction=1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
  CAST(sum(CASE WHEN label=0 AND prediction=1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
  CAST(sum(CASE WHEN label=1 AND prediction=0 THEN 1 ELSE 0 END) AS DOUBLE) AS fn,
  CAST(sum(CASE WHEN label=0 AND prediction=0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn FROM guess)""",
        """m AS (SELECT tn/nullif(tn+fn, 0) AS p0, tn/nullif(tn+fp, 0) AS r0, 2*tn/nullif(2*tn+fn+fp, 0) AS f0, tn+fp AS s0,
  tp/nullif(tp+fp, 0) AS p1, tp/nullif(tp+fn, 0) AS r1, 2*tp/nullif(2*tp+fn+fp, 0) AS f1, tp+fn AS s1,
  (tp+tn)/(tp+tn+fp+fn) AS acc FROM c)""",
    ),
    "regression_report": text(
        f"{VALUE_VIEWS} customer_scores",
        """SELECT 'fixed' AS model, round(sqrt(avg(e*e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae, round(1 - avg(e*e)/var_pop(a), 6) AS r2
FROM (SELECT CAST(w.total_ltv AS DOUBLE) AS a, CAST(w.total_ltv AS DOUBLE) - CAST(s.predicted_ltv AS DOUBLE) AS e
  FROM worth w JOIN g_customer_scores s ON s.customer_id=w.customer_id) x""",
        WORTH,
    ),
    "actual_vs_predicted_fixed": text(
        f"{VALUE_VIEWS} customer_scores",
        """SELECT CAST(floor((place - 1)*10.0/n) + 1 AS BIGINT) AS decile, count(*) AS n, round(avg(CAST(a AS DOUBLE)), 4) AS avg_actual,
  round(avg(CAST(p AS DOUBLE)), 4) AS avg_predicted, round(avg(CAST(p AS DOUBLE) - CAST(a AS DOUBLE)), 4) AS bias
FROM (SELECT w.total_ltv AS a, s.predicted_ltv AS p, rank() OVER (ORDER BY w.total_ltv) AS place, count(*) OVER () AS n
  FROM worth w JOIN g_customer_scores s ON s.customer_id=w.customer_id) x GROUP BY 1""",
        WORTH,
    ),
    # experiment
    "ab_z_test": text(
        "ab_test_assignments", "SELECT round(pa, 6) AS rate_a, round(pb, 6) AS rate_b, round(z, 6) AS z FROM zed", AB_CELLS, AB_Z
    ),
    # erf(x) = exp(-x^2) * sum of x^(2k+1) / gamma(k + 3/2), all terms positive; p = 1 - erf(|z| / sqrt 2)
    "ab_p_value": text(
        "ab_test_assignments",
        """SELECT round(max(z*z), 6) AS chi_square, round(1 - sum(exp((2*k + 1)*ln(greatest(abs(z), 1e-300)/sqrt(2))
  - lgamma(k + 1.5) - z*z/2)), 6) AS p_value FROM zed, range(200) terms(k)""",
        AB_CELLS,
        AB_Z,
    ),
    "ab_decision": text(
        "ab_test_assignments",
        """SELECT round(pa*100, 2) AS rate_a, round(pb*100, 2) AS rate_b, round((pb-pa)*100, 2) AS lift_pt, round(z, 6) AS z,
  abs(z) > 1.959964 AS significant FROM zed""",
        AB_CELLS,
        AB_Z,
    ),
    "ab_lift": text(
        "ab_test_assignments",
        f"""SELECT round(max(CASE variant WHEN 'B' THEN r END) - max(CASE variant WHEN 'A' THEN r END), 2) AS lift_pt
FROM (SELECT variant, {pct('sum(CASE WHEN converted THEN 1 ELSE 0 END)', 'count(*)', 2)} AS r FROM g_ab_test_assignments GROUP BY 1) v""",
    ),
    "assign_variants": text(
        "ga4_events",
        """SELECT customer_id, 'checkout_redesign' AS experiment_name,
  CASE WHEN substr(md5(concat(CAST(customer_id AS VARCHAR), '-checkout_redesign-42')), 1, 4) < '8000' THEN 'A' ELSE 'B' END AS variant
FROM (SELECT DISTINCT customer_id FROM g_ga4_events WHERE event_name='begin_checkout' AND customer_id IS NOT NULL) e""",
    ),
    **_quality(),
    # reports
    "report_years": text("customers", "SELECT DISTINCT year(signup_date) AS year FROM g_customers"),
    "report_growth": text("customers", "SELECT strftime(signup_date, '%b') AS month, count(*) AS customers FROM g_customers GROUP BY 1"),
    "report_growth_year": text(
        "customers",
        f"SELECT strftime(signup_date, '%b') AS month, count(*) AS customers FROM g_customers WHERE year(signup_date)={REPORT_YEAR} GROUP BY 1",
    ),
    "report_spend_pivot": text(
        "marketing_spend",
        """SELECT strftime(spend_date, '%b') AS month, CAST(sum(CASE channel WHEN 'Google Ads' THEN cost ELSE 0 END) AS DOUBLE) AS "Google",
  CAST(sum(CASE channel WHEN 'Meta Ads' THEN cost ELSE 0 END) AS DOUBLE) AS "Meta" FROM g_marketing_spend GROUP BY 1""",
    ),
    "report_kpis": text(VALUE_VIEWS, KPIS.format(where="", perf=""), WORTH, SPENT, PERFORMANCE),
    "report_kpis_year": text(
        VALUE_VIEWS,
        KPIS.format(where=f"WHERE year(c.signup_date)={REPORT_YEAR}", perf=f"WHERE y={REPORT_YEAR}"),
        WORTH,
        SPENT_Y,
        PERFORMANCE_Y,
    ),
    "report_funnel_pct": text(
        "ga4_events",
        f"""SELECT y AS year, CASE stage WHEN 1 THEN 'Page View' WHEN 2 THEN 'View Item' WHEN 3 THEN 'Add to Cart'
  WHEN 4 THEN 'Begin Checkout' ELSE 'Purchase' END AS stage, n AS value, {pct("n", "top", 1)} AS pct
FROM (SELECT *, first_value(n) OVER (PARTITION BY y ORDER BY stage) AS top FROM funnel WHERE stage IS NOT NULL) f""",
        FUNNEL_Y,
    ),
    "report_retention": text(
        "orders",
        f"SELECT year(p) AS year, strftime(p, '%b') AS month, month(p) AS month_num, {RETAINED} FROM kept WHERE year(p)={REPORT_YEAR}",
        *visits("g_orders", "order_date", "month"),
    ),
    "report_churn_bands": text(
        "customers customer_scores",
        f"""SELECT band, CAST(sum(n) AS BIGINT) AS "count", {half_up("CAST(sum(round(ltv*100)*n) AS HUGEINT)", "100*CAST(sum(n) AS HUGEINT)", 2)} AS avg_ltv
FROM bands GROUP BY band""",
        CHURN_Y,
    ),
    "report_churn_bands_year": text(
        "customers customer_scores", f'SELECT band, n AS "count", ltv AS avg_ltv FROM bands WHERE y={REPORT_YEAR}', CHURN_Y
    ),
    "report_propensity_bands": text(
        "customers customer_scores", 'SELECT band, CAST(sum(n) AS BIGINT) AS "count" FROM bands GROUP BY band', PROPENSITY_Y
    ),
    "report_band_share": text(
        "customers customer_scores",
        f"SELECT band, {SHARE} AS share FROM (SELECT band, CAST(sum(n) AS BIGINT) AS n FROM bands GROUP BY band) b",
        PROPENSITY_Y,
    ),
    "report_ab": text(
        "customers ab_test_assignments",
        """SELECT c.year, v.variant, v.total_assigned, v.total_converted, v.conversion_rate_pct, v.variant IS NOT NULL AS has_data
FROM (SELECT DISTINCT year(signup_date) AS year FROM g_customers) c LEFT JOIN rates v ON v.year=c.year""",
        f"rates AS (SELECT year(assigned_date) AS year, variant, {AB_RATE} FROM g_ab_test_assignments GROUP BY 1, 2)",
    ),
}


def _published(parts: dict[str, tuple[str, str]]) -> str:
    """Every value of the named queries, their rows numbered in the stated order; numbers as numbers, the rest as text."""
    records = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS dataset, row_number() OVER (ORDER BY {order}) AS place, to_json(x) AS record FROM ({sql}) x"
        for name, (sql, order) in parts.items()
    )
    return f"""WITH records AS (
{records}),
fields AS (SELECT dataset, place, record, unnest(json_keys(record)) AS field FROM records),
shown AS (SELECT dataset, place, field, json_extract_string(record, concat('$."', field, '"')) AS shown FROM fields)
SELECT dataset, CAST(place AS BIGINT) AS place, field, try_cast(shown AS DOUBLE) AS number,
  CASE WHEN try_cast(shown AS DOUBLE) IS NULL THEN shown END AS words
FROM shown"""


_SEEN_BY_EVENT = visits("g_ga4_events", "event_date", "month")
_MONTH_OF_YEAR = "year(p) AS year, strftime(p, '%b') AS month, month(p) AS month_num"
_STAGE_LAST = "stage_order NULLS LAST, event_name"
_BY_YEAR = {
    "customer_growth": (ORACLES["customer_growth"], "year, month_num"),
    "spend_trend": (ORACLES["spend_trend_by_channel"], "year, month_num, channel, spend, conversions"),
    "channel_performance_by_year": (ORACLES["channel_performance_by_year"], "year, channel"),
    "channel_performance_all_time": (ORACLES["channel_performance"], "channel"),
    "funnel_by_year": (ORACLES["funnel_by_year"], f"year, {_STAGE_LAST}"),
    "funnel_all_time": (ORACLES["funnel_all_time"], _STAGE_LAST),
    "retention_by_year": (text("ga4_events", f"SELECT {_MONTH_OF_YEAR}, {RETAINED} FROM kept", *_SEEN_BY_EVENT), "year, month_num"),
    "churn_risk_bands_by_year": (ORACLES["churn_bands_by_year"], "year, churn_risk_band"),
    "propensity_bands_by_year": (ORACLES["propensity_bands_by_year"], "year, propensity_band"),
    "ab_test_by_year": (ORACLES["ab_conversion_by_year"], "year, variant"),
    "ab_test_all_time": (ORACLES["ab_conversion"], "variant"),
}
_STAGE_OF = STAGE.replace("event_name", "x.event_name")
ORACLES["sink_json_bundle"] = ORACLES["export_bundle"] = _published(_BY_YEAR)
ORACLES["export_csvs"] = _published(
    {
        "channel_performance": _BY_YEAR["channel_performance_all_time"],
        "funnel_conversion": (ORACLES["funnel_conversion"], f"{_STAGE_OF} NULLS LAST, event_name"),
        "retention_curve": (
            text("ga4_events", f"SELECT strftime(p, '%Y-%m') AS activity_month, {RETAINED} FROM kept", *_SEEN_BY_EVENT),
            "activity_month",
        ),
        "ml_risk_bands": (ORACLES["risk_propensity_bands"], "churn_risk_band NULLS FIRST, propensity_band"),
        "ab_test_results": _BY_YEAR["ab_test_all_time"],
        "spend_trend": (ORACLES["spend_trend_monthly"], "month_sort, channel_clean NULLS FIRST"),
        "customer_breakdown": (
            ORACLES["customer_breakdown"],
            "customer_count DESC, acquisition_channel NULLS FIRST, country NULLS FIRST, customer_type NULLS FIRST",
        ),
    }
)
