"""Physical-plan guards: the shapes that matter at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from martwright.plans.context import Context
from martwright.operators import marts, serving
from martwright.session import scratch_path

# Keys whose builders run training or write tables: their parts' plans are checked, their
# results are in test_models, test_pipelines and tests/llm.
SKIP = {"run_pipeline", "export_all", "make_sample", "ensure_built", "sink_metrics_json",
        "forecast_recursive", "forecast_recursive_by_state", "load_models", "save_models",
        "train_all", "model_checks", "rfm_kmeans", "segment_profile", "segments_by_monetary",
        "rfm_scatter_sample", "scan_parquet_rfm", "forecast_gbt_train", "forecast_seasonal_train",
        "forecast_seasonal_by_state", "scan_csv_all", "pipeline"}
KEYS = sorted(k for k in entry.queries() if k not in SKIP and not k.startswith("op"))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", KEYS)
def test_no_cartesian_or_nested_loop(spark, sf_small, key):
    plan = plan_of(entry.queries()[key](spark, sf_small))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_stored_mart_scan_prunes_and_pushes(spark, sf_small):
    ctx = Context(spark, sf_small)
    path = scratch_path(spark, "plan-items")
    ctx.mart("mart_order_items").write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    q = serving.top_categories(stored)
    plan = plan_of(q)
    assert "EqualTo(order_status,delivered)" in plan
    assert "ReadSchema: struct<order_status:string,product_category_en:string,item_gmv:double>" in plan
    assert "TakeOrderedAndProject" in plan


def test_daily_distinct_count_is_partial_aggregated(spark, sf_small):
    ctx = Context(spark, sf_small)
    plan = plan_of(ctx.mart("mart_sales_daily"))
    # map-side partial aggregates before each exchange; distinct handled on (ds, order_id)
    assert "partial_sum" in plan and "partial_count" in plan
    assert plan.count("HashAggregate") >= 4


def test_lean_item_facts_skip_unused_dimension_joins(spark, sf_small):
    ctx = Context(spark, sf_small)
    plan = plan_of(ctx.items("order_id", "order_status", "order_purchase_date", "item_gmv"))
    assert "part.parquet" not in plan and "supplier.parquet" not in plan
    assert "events.parquet" not in plan


def test_order_joins_reuse_aggregate_partitioning(spark, sf_small, monkeypatch):
    """The payment / review aggregates are not re-shuffled for the order_id joins."""
    from martwright.operators import joins
    monkeypatch.setattr(joins, "DEFAULT_BROADCAST_LIMIT", -1)  # plan as at scale: no hints
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ctx = Context(spark, sf_small)
        mo = marts.mart_orders(ctx.stg("orders"), ctx.mart("dim_customers"),
                               ctx.mart("order_payments"), ctx.mart("order_reviews"))
        # orders by order_id, payments by (order_id, type) and by order_id, reviews (the groupBy
        # exchanges by order_id are reused by the joins), then orders by customer_id and customers
        assert plan_of(mo).count("Exchange hashpartitioning") == 6
        items = marts.mart_order_items(
            ctx.stg("order_items"), ctx.stg("orders"), ctx.mart("dim_customers"),
            ctx.mart("order_payments"), ctx.mart("order_reviews"),
            ctx.mart("dim_products"), ctx.mart("dim_sellers"))
        plan = plan_of(items)
        # items go to order_id once (with orders, reviews and both steps of payments), then to
        # product_id and to seller_id
        assert len(re.findall(r"Exchange hashpartitioning\(order_id#", plan)) == 5
        assert "FullOuter" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_exports_shuffle_payments_once(spark, sf_small, monkeypatch):
    """Orders, payments (not twice), reviews by order id; then orders and customers by customer id."""
    from martwright.operators import joins
    from martwright.plans import catalog_io
    monkeypatch.setattr(joins, "DEFAULT_BROADCAST_LIMIT", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seen = {}
        # the marts as the query hands them to the export
        monkeypatch.setattr(catalog_io, "export_marts", lambda marts, out: seen.update(marts) or {})
        monkeypatch.setattr(catalog_io, "_digests", lambda tables: None)
        catalog_io.export_all(Context(spark, sf_small))
        plan = plan_of(seen["mart_orders"])
        assert plan.count("Exchange hashpartitioning") == 5
        # the stored dimensions are not computed again
        assert "customer.parquet" not in plan and "nation.parquet" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_payments_by_one_shuffle_are_those_by_two(spark):
    from martwright.operators.order_aggregates import order_payments
    rows = [("hot", ["b", "a", None, ""][i % 4], i % 7, 0.25 * i) for i in range(500)] + [
        ("o", None, None, None), (None, "a", 2, 1.0), (None, "c", 3, 2.0), ("p", "b", None, 1.5), ("p", "b", 4, None)]
    pay = spark.createDataFrame(rows, "order_id string, payment_type string, payment_installments int, "
                                      "payment_value double").repartition(5)
    one = order_payments(pay, one_shuffle=True)
    assert plan_of(one).count("Exchange hashpartitioning") == 1
    assert sorted(map(repr, one.collect())) == sorted(map(repr, order_payments(pay).collect()))


def test_a_large_stored_dimension_joins_the_narrow_items(spark, sf_small, monkeypatch):
    """Known too large for a broadcast: the items go to its key before they get the orders' columns."""
    from martwright.operators import joins
    monkeypatch.setattr(joins, "DEFAULT_BROADCAST_LIMIT", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ctx = Context(spark, sf_small)
        products = ctx.mart("dim_products")
        products = products.unionByName(products.where("product_id IN ('1', '2')"))  # a key may repeat
        sellers = ctx.mart("dim_sellers").where("seller_id <> '3'")
        args = (ctx.stg("order_items"), ctx.stg("orders").where("order_id NOT LIKE '%7'"), ctx.mart("dim_customers"),
                ctx.mart("order_payments"), ctx.mart("order_reviews"), products, sellers)
        last, first = marts.mart_order_items(*args), marts.mart_order_items(*args, dims_stored=True)
        # the plan's first join is by order id, no longer by seller id
        top = [re.search(r"SortMergeJoin \[(\w+)#", plan_of(df)).group(1) for df in (last, first)]
        assert top == ["seller_id", "order_id"]
        assert last.columns == first.columns
        assert last.exceptAll(first).isEmpty() and first.exceptAll(last).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_reach_the_scan(spark, sf_small):
    ctx = Context(spark, sf_small)
    q = ctx.table("customer").where(F.col("c_nationkey") < 20).select("c_custkey")
    plan = plan_of(q)
    assert "LessThan(c_nationkey,20)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in plan


def test_size_checked_broadcast(spark, sf_small):
    from martwright.operators.joins import estimated_size_bytes, maybe_broadcast
    ctx = Context(spark, sf_small)
    nation = ctx.table("nation")
    assert 0 < estimated_size_bytes(nation) < 1 << 20
    assert "broadcast" in maybe_broadcast(nation)._jdf.queryExecution().logical().toString().lower()
    big = ctx.table("lineitem")
    assert "broadcast" not in maybe_broadcast(big, limit=1024)._jdf.queryExecution() \
        .logical().toString().lower()


@pytest.mark.parametrize("key", ["rfm", "rfm_scale", "insights_all"])
def test_items_are_read_once(spark, sf_small, key):
    """What is left to run after the stored intermediate reads no raw table again."""
    plan = plan_of(entry.queries()[key](spark, sf_small))
    assert "lineitem.parquet" not in plan


def _odd_raw(spark, n_types: int = 3):
    """Raw tables whose keys repeat, are null or have no order."""
    def table(rows, columns):
        return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns.split()))
    t = "2024-01-0{} 10:00:00".format
    items = [(o, "1", p, s, t(1), "10.5", "1.5") for o, p, s in [
        ("a", "p1", "s1"), ("a", "p2", "s2"), ("b", "p1", None), ("c", None, "s1"), ("alone", "p1", "s1"),
        ("paid", "p1", "s1"), ("rated", "p9", "s9"), ("none", "p1", "s1"), (None, "p1", "s1"), ("a", "p1", "s1")]]
    pays = [("a", "1", ["x", "y, ", "", None][i % 4], str(i), "2.5") for i in range(9)] + [
        ("b", "1", None, "3", None), ("alone", "1", "x", "2", "7"), ("paid", "1", "", "4", "8"), (None, "1", "x", "9", "9")]
    pays += [("c", "1", f"t{i:02d}", "1", "1") for i in range(n_types)]
    return {
        "orders": table([(o, c, "delivered", t(d), t(d), t(d), t(5), t(4)) for o, c, d in [
            ("a", "c1", 1), ("a", "c2", 2), ("b", None, 3), ("c", "c1", 1), ("d", "c3", 2), (None, "c1", 3)]],
            "order_id customer_id order_status order_purchase_timestamp order_approved_at "
            "order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date"),
        "order_items": table(items, "order_id order_item_id product_id seller_id shipping_limit_date price freight_value"),
        "payments": table(pays, "order_id payment_sequential payment_type payment_installments payment_value"),
        "reviews": table([(str(i), o, s, t(1), t(2)) for i, (o, s) in enumerate([
            ("a", "1"), ("a", "4"), ("b", None), ("alone", "2"), ("rated", "5"), (None, "3")])],
            "review_id order_id review_score review_creation_date review_answer_timestamp"),
        "customers": table([("c1", "u1", "1", "x", "X"), ("c1", "u2", "2", "y", "Y"), ("c2", "u1", None, "x", "X"),
                            (None, "u3", "1", "z", "Z")], "customer_id customer_unique_id customer_zip_code_prefix "
                                                          "customer_city customer_state"),
        "products": table([("p1", "k1", *["1"] * 7), ("p2", None, *["2.0"] * 7)],
                          "product_id product_category_name product_name_lenght product_description_lenght "
                          "product_photos_qty product_weight_g product_length_cm product_height_cm product_width_cm"),
        "sellers": table([("s1", "1", "x", "X"), ("s2", None, "y", "Y")],
                         "seller_id seller_zip_code_prefix seller_city seller_state"),
        "geolocation": table([("1", "1.5", "2.5", "x", "X")], "geolocation_zip_code_prefix geolocation_lat "
                                                              "geolocation_lng geolocation_city geolocation_state"),
        "category_translation": table([("k1", "e1")], "product_category_name product_category_name_english"),
    }


@pytest.mark.parametrize("n_types", [3, 70])
def test_the_stored_build_joins_the_order_mart_and_lists_no_types(spark, monkeypatch, n_types):
    """Items join the orders' columns once; payments are shuffled once. Rows are those of the lazy build."""
    from martwright.plans.warehouse import MART_TABLES, build_layers, run_pipeline
    from martwright.session import scratch_path
    from martwright.sinks import tables
    write, plans = tables.write_table, {}

    def noted(session, df, path, **kw):
        plans[path.rsplit("/", 1)[1]] = plan_of(df)
        return write(session, df, path, **kw)

    raw = _odd_raw(spark, n_types)
    monkeypatch.setattr(tables, "write_table", noted)
    stored, lazy = run_pipeline(spark, raw, scratch_path(spark, "wh-odd")).mart, build_layers(raw).mart
    for name in MART_TABLES:
        assert stored[name].columns == lazy[name].columns
        assert stored[name].exceptAll(lazy[name]).isEmpty() and lazy[name].exceptAll(stored[name]).isEmpty(), name
    by_id = {r.order_id: (r.payment_value_total, r.review_score_avg, r.order_status) for r in stored["mart_order_items"]
             .where("order_id IN ('alone', 'paid', 'rated', 'none')").collect()}
    assert by_id == {"alone": (7.0, 2.0, None), "paid": (8.0, None, None), "rated": (None, 5.0, None),
                     "none": (None, None, None)}
    # one join of the items by order id, the two that look for ids without an order, and theirs
    items = re.findall(r"Join \[order_id#\d+\], \[order_id#\d+\], (\w+)", plans["mart_order_items"])
    assert sorted(items) == ["FullOuter", "LeftAnti", "LeftAnti", "LeftOuter"]
    assert "customer_zip" not in plans["mart_order_items"] and "order_status" in plans["mart_order_items"]
    # more types than bits: lists, as before
    assert ("collect" in plans["order_payments"]) == (n_types > 62)
    assert plans["order_payments"].count("Exchange hashpartitioning") == (2 if n_types > 62 else 1)
