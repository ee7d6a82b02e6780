"""A hot key holding a third of all rows is split at runtime, and results stay whole."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from martwright.operators import joins, marts
from martwright.plans.context import Context

SF = "/root/testdata/sf0.01"


@pytest.fixture
def skew_conf(spark, monkeypatch):
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    monkeypatch.setattr(joins, "DEFAULT_BROADCAST_LIMIT", -1)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    qe.executedPlan().execute().count()
    return qe.executedPlan().toString()


def test_hot_product_is_split_by_aqe(spark, skew_conf):
    ctx = Context(spark, SF)
    items = ctx.stg("order_items")
    # one product receives a third of all item rows
    # AQE splits a skewed partition along map-output boundaries, so the fixture needs
    # several map tasks (one small file gives one mapper; real inputs have thousands).
    hot = items.repartition(8).withColumn(
        "product_id", F.when(F.abs(F.xxhash64("order_id", "order_item_id")) % 3 == 0,
                             F.lit("1")).otherwise(F.col("product_id")))
    joined = joins.left_join_dim(hot, ctx.mart("dim_products")
                                 .select("product_id", "product_category_en"), "product_id")
    plan = _final_plan(joined)
    assert "SortMergeJoin" in plan and "skew=true" in plan
    assert joined.count() == items.count()


def test_hot_day_daily_mart_is_exact(spark, skew_conf):
    """A day holding a third of all delivered items: same totals as without the skew trick."""
    ctx = Context(spark, SF)
    facts = ctx.mart("item_sales_facts")
    hot = facts.withColumn("order_purchase_date",
                           F.when(F.abs(F.xxhash64("order_id")) % 3 == 0,
                                  F.lit("2000-01-01").cast("date"))
                           .otherwise(F.col("order_purchase_date")))
    daily = marts.mart_sales_daily(hot)
    tot = daily.agg(F.sum("orders"), F.sum("items")).first()
    base = marts.delivered_filter(facts).agg(F.count_distinct("order_id"), F.count("*")).first()
    assert tuple(tot) == tuple(base)


def test_sample_of_a_table_without_a_key_whose_rows_repeat(spark):
    """A third of all rows are equal: they are counted, not ordered, and the sample is exact."""
    from martwright.operators.sampling import sample_exact_n, sample_hash
    df = (spark.range(2000).select((F.col("id") % 700).alias("a"), F.lit("x").alias("b"))
          .unionByName(spark.range(1000).select(F.lit(-1).cast("long").alias("a"), F.lit("hot").alias("b"))))
    order = sorted((r.h, r.a, r.b) for r in df.select(sample_hash(["a", "b"]).alias("h"), "a", "b").collect())
    for n in (1, 10, 500, 1500, 2999, 3000, 5000):
        got = sorted((r.h, r.a, r.b) for r in
                     sample_exact_n(df, n, ["a", "b"]).select(sample_hash(["a", "b"]).alias("h"), "a", "b").collect())
        assert got == order[:n]


def test_order_payments_plan_has_no_object_aggregate_over_payments(spark, sf_small):
    """Payments are aggregated by (order, type) in hash maps; only those few rows are listed."""
    from martwright.operators.order_aggregates import order_payments
    rows = [("hot", i % 3, ["a", "b", None][i % 3], 1, 2.0) for i in range(3000)] + [("o", 1, None, 1, 5.0)]
    pay = spark.createDataFrame(rows, "order_id string, payment_sequential int, payment_type string, "
                                      "payment_installments int, payment_value double")
    out = order_payments(pay)
    got = {r.order_id: (r.payment_value_total, r.payment_installments_max, r.payment_types) for r in out.collect()}
    assert got == {"hot": (6000.0, 1, "a, b"), "o": (5.0, 1, None)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    lists = plan.index("collect_list")
    assert "keys=[order_id" in plan[lists - 200:] and "payment_type" in plan[plan.rindex("HashAggregate"):]
