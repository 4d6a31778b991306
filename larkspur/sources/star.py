"""The eight tables derived from the order-star Parquet files (customer, nation, orders, lineitem, events).

Each view is one SQL text that Spark and DuckDB both run, so that a check against DuckDB starts from the same rows.
Texts name their inputs in braces: base files by file name, earlier views by table name.
"""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.sources.tables import Tables, in_range

AS_OF = date(2001, 12, 31)

# The columns the views use, declared, so that opening a file starts no job.
BASE: dict[str, str] = {
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
    "star_orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
}

VIEWS: dict[str, str] = {
    "customers": """
SELECT c_custkey AS customer_id, DATE '1995-01-01' + CAST((c_custkey*37)%2404 AS INT) AS signup_date,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Google' WHEN 'BUILDING' THEN 'Meta' WHEN 'FURNITURE' THEN 'Organic'
    WHEN 'MACHINERY' THEN 'Referral' ELSE CASE WHEN c_custkey%2=0 THEN 'Direct' ELSE 'Email' END END
    AS acquisition_channel,
  n_name AS country,
  CASE WHEN (c_custkey*7)%20<11 THEN 'ecommerce' WHEN (c_custkey*7)%20<17 THEN 'saas' ELSE 'both' END AS customer_type
FROM {customer} JOIN {nation} ON c_nationkey=n_nationkey""",
    "marketing_spend": """
SELECT l_orderkey*10+l_linenumber AS spend_id, CAST(l_shipdate AS DATE) AS spend_date,
  CASE l_linestatus WHEN 'F' THEN 'Google Ads' ELSE 'Meta Ads' END AS channel, l_returnflag AS campaign_name,
  CAST(l_quantity AS INT)*60 AS impressions, CAST(l_quantity AS INT) AS clicks,
  CAST(l_extendedprice AS DECIMAL(12,2)) AS cost, CAST(FLOOR(l_quantity/10) AS INT) AS conversions
FROM {lineitem}""",
    "ga4_events": """
SELECT event_id, user_id AS customer_id, CAST(ts AS DATE) AS event_date,
  CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'view_item' WHEN 'signup' THEN 'add_to_cart'
    WHEN 'error' THEN 'begin_checkout' ELSE 'purchase' END AS event_name,
  concat('/', event_type) AS page_path,
  concat(CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING)) AS session_id,
  CASE WHEN (user_id+day(ts))%20<9 THEN 'desktop' WHEN (user_id+day(ts))%20<18 THEN 'mobile' ELSE 'tablet' END
    AS device_category
FROM {events}""",
    "orders": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
  o_orderpriority AS product_name, CAST(1+o_orderkey%4 AS INT) AS quantity,
  CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'refunded' ELSE 'cancelled' END AS order_status
FROM {star_orders}""",
    "subscriptions": """
SELECT customer_id AS subscription_id, customer_id, plan_name, start_date,
  CASE WHEN status='active' THEN NULL
       ELSE LEAST(start_date + CAST(30+(customer_id*17)%471 AS INT), DATE '2001-12-31') END AS end_date,
  CAST(CASE plan_name WHEN 'Basic' THEN 15 WHEN 'Pro' THEN 45 ELSE 150 END AS DECIMAL(10,2)) AS mrr, status
FROM (SELECT customer_id,
    CASE WHEN CAST(FLOOR(customer_id/20) AS BIGINT)%20<11 THEN 'Basic'
         WHEN CAST(FLOOR(customer_id/20) AS BIGINT)%20<18 THEN 'Pro' ELSE 'Enterprise' END AS plan_name,
    signup_date + CAST(customer_id%15 AS INT) AS start_date,
    CASE WHEN CAST(FLOOR(customer_id/7) AS BIGINT)%20<14 THEN 'active'
         WHEN CAST(FLOOR(customer_id/7) AS BIGINT)%20<19 THEN 'cancelled' ELSE 'paused' END AS status
  FROM {customers} WHERE customer_type IN ('saas','both')) q""",
    "crm_engagement": """
SELECT l_orderkey*10+l_linenumber AS engagement_id, o_custkey AS customer_id,
  CASE l_suppkey%5 WHEN 0 THEN 'Welcome Series' WHEN 1 THEN 'Cart Abandonment' WHEN 2 THEN 'Weekly Newsletter'
    WHEN 3 THEN 'Win-Back' ELSE 'Product Announcement' END AS campaign_name,
  CASE WHEN l_linenumber<=5 THEN 'email' WHEN l_linenumber=6 THEN 'push' ELSE 'sms' END AS channel,
  CAST(l_shipdate AS DATE) AS sent_date, l_returnflag='R' AS opened,
  (l_returnflag='R' AND l_discount>=0.08) AS clicked
FROM {lineitem} JOIN {star_orders} ON l_orderkey=o_orderkey""",
    "ab_test_assignments": """
SELECT customer_id AS assignment_id, customer_id, 'checkout_redesign' AS experiment_name,
  CASE WHEN customer_id%2=0 THEN 'A' ELSE 'B' END AS variant,
  DATE '2001-12-31' + CAST(-(customer_id%61) AS INT) AS assigned_date,
  (CAST(FLOOR(customer_id/2) AS BIGINT)*31)%100 < CASE WHEN customer_id%2=0 THEN 25 ELSE 29 END AS converted
FROM (SELECT DISTINCT customer_id FROM {orders}) e""",
    "customer_scores": """
SELECT c.customer_id,
  CASE WHEN s.customer_id IS NOT NULL THEN CAST(((c.customer_id*6151)%10001)/10000.0 AS DECIMAL(5,4)) END
    AS churn_risk_score,
  CAST(((c.customer_id*7919)%10001)/10000.0 AS DECIMAL(5,4)) AS purchase_propensity_score,
  CAST(((c.customer_id*104729)%453600)/100.0 AS DECIMAL(10,2)) AS predicted_ltv,
  TIMESTAMP '2001-12-31 00:00:00' AS scored_at
FROM {customers} c
LEFT JOIN (SELECT customer_id FROM {subscriptions} WHERE status='active') s ON c.customer_id=s.customer_id""",
}


def inputs_of(view: str) -> list[str]:
    """Base files and earlier views that a view reads."""
    return sorted(set(re.findall(r"{(\w+)}", VIEWS[view])))


# The base column that dates a fact; a range of days is cut there, where the files' statistics can skip row groups.
DATED: dict[str, tuple[str, str]] = {
    "orders": ("star_orders", "o_orderdate"), "ga4_events": ("events", "ts"), "marketing_spend": ("lineitem", "l_shipdate"),
}


def star_tables(spark: SparkSession, folder: str) -> Tables:
    """The eight tables over the Parquet files in ``folder``."""
    built: dict[str, DataFrame] = {}

    def resolve(name: str) -> DataFrame:
        if name not in built:
            if name in BASE:
                built[name] = spark.read.schema(BASE[name]).parquet(f"{folder}/{name.removeprefix('star_')}.parquet")
            else:
                built[name] = spark.sql(VIEWS[name], **{n: resolve(n) for n in inputs_of(name)})
        return built[name]

    def source(name: str) -> DataFrame:
        return resolve(name)

    def ranged(name: str, since: date | None = None, until: date | None = None) -> DataFrame:
        if name not in DATED:
            return in_range(resolve(name), name, since, until)
        base, column = DATED[name]
        rows = resolve(base)
        if since is not None:
            rows = rows.where(F.col(column) >= F.lit(since.isoformat()).cast("timestamp_ntz"))
        if until is not None:
            rows = rows.where(F.col(column) < F.lit((until + timedelta(days=1)).isoformat()).cast("timestamp_ntz"))
        return spark.sql(VIEWS[name], **{n: rows if n == base else resolve(n) for n in inputs_of(name)})

    source.ranged = ranged
    return Tables(source)


def view_prefix(*names: str) -> str:
    """``WITH`` list for an ANSI SQL text that uses the given views, called ``g_<name>``; dependencies come first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in BASE or name in order:
            return
        for needed in inputs_of(name):
            visit(needed)
        order.append(name)

    for name in names:
        visit(name)
    renamed = {n: n.removeprefix("star_") for n in BASE} | {n: f"g_{n}" for n in VIEWS}
    return "WITH " + ",\n".join(f"g_{n} AS ({VIEWS[n].format(**renamed)})" for n in order)
