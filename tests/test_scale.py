"""Skewed data, recomputation and plan shapes."""

import re

import numpy as np
import pytest
from places import STAR
from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur.catalog import MODEL_QUERIES, QUERIES
from larkspur.operators import aggregates, ids, scale, windows
from larkspur.operators.aggregates import target_summary
from larkspur.plans import features, metrics


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows of which a third have key 7 and some have none."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 400)
    return spark.range(3000).select("id", key.cast("long").alias("k"))


def test_hot_key_is_found_and_split_by_its_size(spark, skewed):
    code = spark.range(1).select(F.xxhash64(F.lit(7).cast("long"))).first()[0]
    assert scale.hot_parts(skewed, ["k"], task_rows=300) == {4: [code]}
    assert scale.hot_parts(skewed, ["k"], task_rows=100) == {16: [code]}
    assert scale.hot_parts(skewed, ["k"]) == {}
    assert scale.hot_parts(skewed.limit(0), ["k"], task_rows=1) == {}


def test_hot_keys_with_empty_tasks(spark, skewed):
    """Sketches in fewer tasks than there are partitions, without AQE merging the empty ones away."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    try:
        spark.conf.set(setting, "false")
        assert list(scale.hot_parts(skewed.coalesce(1), ["k"], task_rows=300)) == [4]
    finally:
        spark.conf.set(setting, "true")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("task_rows", [2, 100])
def test_split_join_equals_plain_join(spark, skewed, how, task_rows):
    per_key = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = scale.skew_safe_join(skewed, per_key, ["k"], how, spread=["id"], task_rows=task_rows)
    plain = skewed.join(per_key, "k", how).select("id", "k", "v")
    assert sorted(map(tuple, joined.select("id", "k", "v").collect()), key=str) == sorted(
        map(tuple, plain.collect()), key=str
    )


def test_parts_spread_the_hot_key_evenly(skewed):
    parts = scale._parts(["k"], scale.hot_parts(skewed, ["k"], task_rows=100))
    part = F.pmod(F.xxhash64("id"), parts).alias("part")
    sizes = skewed.where("k = 7").groupBy(part).count().collect()
    assert len(sizes) == 16 and max(r["count"] for r in sizes) < 100


def test_split_join_matches_missing_keys_as_equal(spark, skewed):
    per_key = spark.createDataFrame([(None, "none"), (7, "seven")], "k long, v string")
    joined = scale.skew_safe_join(skewed, per_key, ["k"], task_rows=10)
    counts = {r.v: r["count"] for r in joined.groupBy("v").count().collect()}
    assert counts == {"none": skewed.where("k is null").count(), "seven": skewed.where("k = 7").count()}


def test_small_side_is_broadcast_only_when_counted_small(spark, skewed):
    per_key = spark.range(400).select(F.col("id").alias("k"), F.col("id").alias("v"))
    small = scale.attach_small(skewed, per_key, ["k"], max_rows=400)
    large = scale.attach_small(skewed, per_key, ["k"], max_rows=399)
    hinted = "strategy=broadcast"
    assert hinted in small._jdf.queryExecution().analyzed().toString()
    assert hinted not in large._jdf.queryExecution().analyzed().toString()
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))


def test_running_cost_without_broadcast(star, monkeypatch):
    order = ["channel", "spend_date", "cost"]
    want = sorted(map(tuple, windows.running_channel_cost(star).select(*order, "running_total_cost").collect()))
    monkeypatch.setattr(scale.attach_small, "__defaults__", ("inner", "small", 0))
    assert sorted(map(tuple, windows.running_channel_cost(star).select(*order, "running_total_cost").collect())) == want


@pytest.mark.parametrize("descending", [True, False])
def test_positions_equal_a_plain_window(spark, descending):
    value = F.when(F.col("id") % 3 == 0, 25).otherwise(F.pmod(F.xxhash64("id"), F.lit(2_000_000)) / 100 - 5000)
    frame = spark.range(3000).select((F.col("id") % 4).alias("g"), value.cast("decimal(18,2)").alias("v"))
    counted = frame.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    placed = scale.positions(counted, "v", group=["g"], descending=descending)
    got = {(r.g, r.v): (r.before + 1, r.total) for r in placed.collect()}
    order = F.col("v").desc() if descending else F.col("v").asc()
    ranked = frame.select(
        "g", "v", F.rank().over(Window.partitionBy("g").orderBy(order)).alias("r"),
        F.count(F.lit(1)).over(Window.partitionBy("g")).alias("total"),
    )
    assert got == {(r.g, r.v): (r.r, r.total) for r in ranked.collect()}


def test_leading_digits_keep_the_order(spark):
    values = [-12399, -12345, -999, -1, 0, 1, 99, 999, 1000, 1009, 1010, 99999, 100000, 123456789]
    frame = spark.createDataFrame([(v / 100,) for v in values], "v double").select(F.col("v").cast("decimal(18,2)").alias("v"))
    buckets = [r[0] for r in frame.select(scale.leading_digits(F.col("v"))).collect()]
    assert buckets == sorted(buckets)
    assert buckets[-1] == 123000000 and buckets[0] == -12300


def test_percentiles_equal_numpy(spark):
    values = [round(float(v), 2) for v in np.random.default_rng(5).lognormal(5, 1.5, 997)] + [0.0] * 400
    summary = target_summary(spark.createDataFrame([(v,) for v in values], "v double"), "v").first()
    want = [len(values), np.mean(values), np.std(values, ddof=1), min(values), *np.percentile(values, [25, 50, 75]), max(values)]
    assert list(summary) == pytest.approx(want)


def test_rank_with_a_spend_many_share(make):
    from datetime import date
    from decimal import Decimal as D

    spends = [D("25.00")] * 40 + [D("30.00"), D("30.00"), D("12.50"), D("99.99")]
    t = make(
        customers=[{"customer_id": i, "country": None if i % 2 else "India"} for i in range(len(spends))],
        orders=[
            {"order_id": i, "customer_id": i, "order_date": date(2026, 1, 1), "total_amount": s, "order_status": "completed"}
            for i, s in enumerate(spends)
        ],
    )
    got = {r.customer_id: r.spend_rank for r in windows.spend_rank_in_country(t).collect()}
    assert len(got) == len(spends)
    for i, s in enumerate(spends):
        assert got[i] == 1 + sum(1 for j, other in enumerate(spends) if j % 2 == i % 2 and other > s)


@pytest.mark.parametrize("digits", [1, 4])
def test_stratified_parts_hold_every_class_share(spark, digits):
    rows = spark.range(1000).selectExpr("id AS k", "cast(id % 7 = 0 AS int) AS y").repartition(5)
    rows = rows.union(spark.createDataFrame([(3, 1), (7, 0)], "k long, y int"))  # a second row, of another class
    split = ids.stratified_hold_out(rows, "k", "y", digits=digits).collect()
    label, side = {}, {}
    for r in split:
        label[r.k] = max(label.get(r.k, 0), r.y)
        assert side.setdefault(r.k, r.is_test) == r.is_test
    for y in (0, 1):
        mine = [k for k in label if label[k] == y]
        assert sum(side[k] for k in mine) == round(0.2 * len(mine))
    assert len(split) == 1002 and ids.stratified_hold_out(rows.where("false"), "k", "y").count() == 0


@pytest.mark.parametrize("values", [["0.35"] * 7, ["4.35"] * 7, ["0.29"] * 3, ["1.13"] * 1000, ["0.07"] * 3, ["1000000.01", "1000000.02"], ["-3.00", "5.50", "1.25"]])
def test_spread_of_close_values(spark, values):
    import statistics
    from decimal import Decimal as D

    rows = spark.createDataFrame([(D(v),) for v in values] + [(None,)], "v decimal(12,2)")
    got = aggregates.target_summary(rows, "v").first()
    assert got.std == pytest.approx(float(statistics.stdev(map(D, values))), abs=1e-12) and got["count"] == len(values)


def test_ids_are_gapless_and_do_not_depend_on_partitions(spark):
    def numbered(parts: int):
        return {r.k: r.id for r in ids.assign_ids(spark.range(5000).toDF("k").repartition(parts), "k", digits=2).collect()}

    first = numbered(1)
    assert sorted(first.values()) == list(range(1, 5001))
    assert numbered(7) == first


@pytest.mark.parametrize("parts", ["2", "8"])
def test_hash_cuts_do_not_depend_on_partitions(spark, star, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        held = ids.hold_out(star.customers, "customer_id").where("is_test").select("customer_id").collect()
        side = ids.assign_variants(star.customers, "x").where("variant = 'A'").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(r[0] for r in held) == [r for r in range(150) if _held(r)]
    assert side == sum(_side(r) for r in range(150))


def _md5(text: str) -> str:
    import hashlib

    return hashlib.md5(text.encode()).hexdigest()[:4]


def _held(i: int) -> bool:
    return _md5(f"{i}-42") < "3333"


def _side(i: int) -> bool:
    return _md5(f"{i}-x-42") < "8000"


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(MODEL_QUERIES)))
def test_no_pairwise_joins_and_no_python(spark, name):
    plan = _plan(QUERIES[name](spark, STAR))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|EvalPython|InPandas", plan)


def test_filters_and_columns_reach_the_scan(spark, tmp_path, make):
    from datetime import date

    from larkspur import Tables
    from larkspur.operators import filters

    make(ga4_events=[{"event_id": 1, "customer_id": 1, "event_date": date(2026, 1, 1), "event_name": "purchase"}]
         ).ga4_events.write.parquet(str(tmp_path / "ga4_events"))
    plan = _plan(filters.purchase_events(Tables.from_folder(spark, str(tmp_path))))
    assert "EqualTo(event_name,purchase)" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert schema.replace(" ", "") == "customer_id:bigint,event_date:date,event_name:string"


def test_each_fact_is_read_once_for_the_feature_tables(spark, star):
    from larkspur.sources.star import AS_OF

    for frame, lineitem, events in (
        (features.ltv_features(star, AS_OF), 1, 1),
        (features.churn_features(star, AS_OF), 1, 1),
        (metrics.channel_performance(star, AS_OF), 1, 0),
    ):
        plan = _plan(frame)
        assert plan.count("/lineitem.parquet") == lineitem
        assert plan.count("/events.parquet") == events


def test_skewed_rows_of_one_customer_reach_many_tasks(make, spark):
    """A join by customer with one customer holding half of the orders."""
    from datetime import date
    from decimal import Decimal as D

    from larkspur.operators import joins

    t = make(
        customers=[{"customer_id": i, "country": "India"} for i in range(50)],
        orders=[
            {"order_id": i, "customer_id": 0 if i % 2 else i % 50, "order_date": date(2026, 1, 1),
             "total_amount": D("1.00"), "order_status": "completed"}
            for i in range(400)
        ],
    )
    assert joins.completed_orders_with_country(t).count() == 400
    setting = "spark.sql.adaptive.skewJoin.enabled"
    try:
        spark.conf.set(setting, "false")
        assert joins.completed_orders_with_country(t).count() == 400
    finally:
        spark.conf.set(setting, "true")
    orders = joins.completed_orders(t)
    salted = scale.skew_safe_join(orders, t.customers, ["customer_id"], spread=["order_id"], task_rows=20)
    assert salted.count() == 400
    assert "_part" in salted._jdf.queryExecution().optimizedPlan().toString()


def test_orders_are_read_once_for_their_countries(spark):
    plan = _plan(QUERIES["completed_orders_with_country"](spark, STAR))
    assert plan.count("/orders.parquet") == 1
