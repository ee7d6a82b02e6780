"""Hand-made edge frames (≤ 10 rows) for the semantics that small data hides."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martwright.functions import day_boundaries_between, is_late, weekday_name
from martwright.operators import features, insights, marts, order_aggregates, sampling
from martwright.operators import segmentation, staging, dimensions

D = dt.date
T = dt.datetime


def test_is_late_three_valued(spark):
    df = spark.createDataFrame(
        [(T(2020, 1, 2), T(2020, 1, 1)), (T(2020, 1, 1), T(2020, 1, 1)), (None, T(2020, 1, 1)),
         (T(2020, 1, 1), None), (T(2020, 1, 1, 0, 0, 1), T(2020, 1, 1))],
        "d timestamp_ntz, e timestamp_ntz")
    got = [r[0] for r in df.select(is_late("d", "e")).collect()]
    assert got == [1, 0, None, None, 1]


def test_day_boundaries_not_24h(spark):
    df = spark.createDataFrame([(T(2020, 1, 1, 23, 30), T(2020, 1, 2, 0, 30)),
                                (T(2020, 1, 2, 0, 30), T(2020, 1, 1, 23, 30))],
                               "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(day_boundaries_between("a", "b")).collect()]
    assert got == [1, -1]
    assert dict(df.select(day_boundaries_between("a", "b").alias("x")).dtypes)["x"] == "bigint"


def test_try_cast_timestamps_bad_text_is_null(spark):
    raw = spark.createDataFrame(
        [("1", "c", "delivered", "2018-01-01 10:00:00", "", "2018-02-30 00:00:00", "garbage",
          "2018-01-05")],
        ",".join(f"{c} string" for c in ["order_id", "customer_id", "order_status",
                                         "order_purchase_timestamp", "order_approved_at",
                                         "order_delivered_carrier_date",
                                         "order_delivered_customer_date",
                                         "order_estimated_delivery_date"]))
    r = staging.stage_orders(raw).first()
    assert r.order_purchase_ts == T(2018, 1, 1, 10)
    assert r.order_approved_ts is None            # empty string
    assert r.order_delivered_carrier_ts is None   # Feb 30
    assert r.order_delivered_customer_ts is None  # garbage
    assert r.order_estimated_delivery_ts == T(2018, 1, 5)  # date-only text accepted


def test_zip_prefix_leading_zero_and_products_float_text(spark):
    cust = spark.createDataFrame([("c1", "u1", "01037", "sp", "SP")],
                                 "customer_id string, customer_unique_id string, "
                                 "customer_zip_code_prefix string, customer_city string, "
                                 "customer_state string")
    assert staging.stage_customers(cust).first().customer_zip_prefix == 1037
    prod = spark.createDataFrame(
        [("p1", "cat", "58.0", "100", "2.0", "500", "10", "5", "3")],
        ",".join(f"{c} string" for c in ["product_id", "product_category_name",
                                         "product_name_lenght", "product_description_lenght",
                                         "product_photos_qty", "product_weight_g",
                                         "product_length_cm", "product_height_cm",
                                         "product_width_cm"]))
    r = staging.stage_products(prod).first()
    assert (r.product_name_length, r.product_description_length, r.product_photos_qty) == (58, 100, 2)
    assert r.product_weight_g == 500.0


def test_strict_cast_fails_on_bad_integer(spark):
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        pytest.skip("strict casts need ANSI mode")
    pay = spark.createDataFrame([("o1", "x", "boleto", "1", "10.0")],
                                "order_id string, payment_sequential string, payment_type string, "
                                "payment_installments string, payment_value string")
    with pytest.raises(Exception):
        staging.stage_payments(pay).collect()


def test_geolocation_aggregate_and_unmatched_zip(spark):
    geo = spark.createDataFrame(
        [(1, None, "S", 1.0, 2.0), (1, "b", "S", 3.0, 4.0), (1, "a", None, 5.0, 6.0),
         (2, None, None, 0.0, 0.0)],
        "geolocation_zip_code_prefix int, geolocation_city string, geolocation_state string, "
        "geolocation_lat double, geolocation_lng double")
    g = {r.zip_prefix: r for r in staging.stage_geolocation(geo).collect()}
    assert (g[1].city, g[1].state, g[1].lat, g[1].lng) == ("a", "S", 3.0, 4.0)
    assert g[2].city is None  # all-NULL city in a zip stays NULL
    cust = spark.createDataFrame([("c1", "u1", 1, "x", "y"), ("c2", "u2", 99, "x", "y")],
                                 "customer_id string, customer_unique_id string, "
                                 "customer_zip_prefix int, customer_city string, "
                                 "customer_state string")
    dim = {r.customer_id: r for r in dimensions.dim_customers(
        cust, staging.stage_geolocation(geo)).collect()}
    assert dim["c1"].customer_lat == 3.0 and dim["c2"].customer_lat is None


def test_payment_types_sorted_distinct_and_null(spark):
    pay = spark.createDataFrame(
        [("o1", 1, "voucher", 1, 1.0), ("o1", 2, "boleto", 3, 2.0), ("o1", 3, "voucher", 2, 3.0),
         ("o2", 1, None, 1, 5.0)],
        "order_id string, payment_sequential int, payment_type string, "
        "payment_installments int, payment_value double")
    got = {r.order_id: r for r in order_aggregates.order_payments(pay).collect()}
    assert got["o1"].payment_types == "boleto, voucher"
    assert got["o1"].payment_value_total == 6.0 and got["o1"].payment_installments_max == 3
    assert got["o2"].payment_types is None


def test_category_coalesce(spark):
    prod = spark.createDataFrame([("p1", "a"), ("p2", "b"), ("p3", None)],
                                 "product_id string, product_category_name string")
    tr = spark.createDataFrame([("a", "a_en")], "product_category_name string, "
                                                "product_category_name_english string")
    got = {r.product_id: r.product_category_en
           for r in dimensions.dim_products(prod, tr).collect()}
    assert got == {"p1": "a_en", "p2": "b", "p3": None}


ORDER_SCHEMA = ("order_id string, customer_id string, order_status string, "
                "order_purchase_ts timestamp_ntz, order_delivered_customer_ts timestamp_ntz, "
                "order_estimated_delivery_ts timestamp_ntz")


def _item_mart(spark, item_orders, orders, payments, reviews):
    items = spark.createDataFrame([(o, k, "p", "s", 1.0, 1.0) for k, o in enumerate(item_orders)],
                                  "order_id string, order_item_id int, product_id string, "
                                  "seller_id string, price double, freight_value double")
    o = spark.createDataFrame(orders, ORDER_SCHEMA)
    cust = spark.createDataFrame([("c1", "u1", "x", "S")], "customer_id string, "
                                 "customer_unique_id string, customer_city string, "
                                 "customer_state string")
    pay = spark.createDataFrame(payments, "order_id string, payment_value_total double, "
                                "payment_installments_max int, payment_types string")
    rev = spark.createDataFrame(reviews, "order_id string, review_score_avg double")
    prods = spark.createDataFrame([], "product_id string, product_category_en string")
    sells = spark.createDataFrame([], "seller_id string, seller_city string, seller_state string")
    return (marts.mart_order_items(items, o, cust, pay, rev, prods, sells),
            marts.mart_orders(o, cust, pay, rev))


def test_items_of_unknown_orders_keep_their_payments(spark):
    items, orders = _item_mart(spark, ["o9"], [], [("o9", 7.0, 1, "boleto")], [])
    r = items.first()
    assert r.payment_value_total == 7.0 and r.order_status is None and r.item_gmv == 2.0
    assert orders.count() == 0


def _series(spark, n, start=D(2020, 1, 1), step=1, y=lambda i: float(i + 1)):
    rows = [(start + dt.timedelta(days=i * step), y(i), 1, 1) for i in range(n)]
    return spark.createDataFrame(rows, "ds date, y double, orders bigint, items bigint")


def test_lags_count_rows_not_days(spark):
    gappy = spark.createDataFrame(
        [(D(2020, 1, 1), 1.0), (D(2020, 1, 5), 2.0), (D(2020, 2, 1), 3.0)], "ds date, y double")
    rows = features.lag_features(gappy, lags=(1,), rolls=(2,)).orderBy("ds").collect()
    assert [r.lag_1 for r in rows] == [None, 1.0, 2.0]
    assert [r.roll_2 for r in rows] == [None, None, 1.5]


def test_rolling_needs_full_window(spark):
    df = spark.createDataFrame([(D(2020, 1, i), None if i == 3 else float(i)) for i in range(1, 10)],
                               "ds date, y double")
    rows = features.lag_features(df, lags=(), rolls=(3,)).orderBy("ds").collect()
    # windows containing the NULL on day 3 (targets 4, 5, 6) have < 3 values → NULL
    assert [r.roll_3 for r in rows] == [None, None, None, None, None, None, 5.0, 6.0, 7.0]


@pytest.mark.parametrize("n,test_rows", [(59, 0), (60, 0), (61, 60)])
def test_time_split_sizes(spark, n, test_rows):
    split = features.time_split(_series(spark, n), 60)
    assert split.where(F.col("split") == "test").count() == test_rows
    if test_rows:
        first_test = split.where(F.col("split") == "test").agg(F.min("ds")).first()[0]
        assert first_test == D(2020, 1, 1) + dt.timedelta(days=1)


@pytest.mark.parametrize("n,expect_trend,expect_best", [(6, False, False), (7, False, True),
                                                         (59, False, True), (60, True, True),
                                                         (61, True, True)])
def test_insight_rules_thresholds(spark, n, expect_trend, expect_best):
    daily = _series(spark, n)
    assert (insights.insight_gmv_trend(daily).count() == 1) is expect_trend
    assert (insights.insight_best_weekday(daily).count() == 1) is expect_best


def test_trend_text_and_zero_previous(spark):
    daily = _series(spark, 60, y=lambda i: 1.0 if i < 30 else 2.0)
    assert insights.insight_gmv_trend(daily).first().insight == \
        "GMV is up 100.0% in the last 30 days vs the previous 30 days."
    zero_prev = _series(spark, 60, y=lambda i: 0.0 if i < 30 else 2.0)
    assert insights.insight_gmv_trend(zero_prev).count() == 0


def test_weekday_names_are_full(spark):
    df = spark.createDataFrame([(D(2018, 1, 1),)], "ds date")
    assert df.select(weekday_name("ds")).first()[0] == "Monday"


def test_kpi_on_empty_daily_is_one_null_row(spark):
    empty = spark.createDataFrame([], "ds date, y double, orders bigint, items bigint")
    rows = marts.kpi_summary(empty).collect()
    assert len(rows) == 1 and all(v is None for v in rows[0])
    assert insights.insight_total_gmv(marts.kpi_summary(empty)).count() == 0


def test_rfm_single_customer_and_zero_variance(spark):
    items = spark.createDataFrame(
        [("u1", "o1", D(2020, 1, 1), 10.0), ("u1", "o1", D(2020, 1, 1), 5.0),
         ("u1", "o2", D(2020, 1, 3), None), (None, "o3", D(2020, 1, 9), 1.0)],
        "customer_unique_id string, order_id string, order_purchase_date date, item_gmv double")
    r = segmentation.rfm(items).collect()
    assert len(r) == 1
    # as-of = latest purchase of the whole input (the NULL-customer row, Jan 9) + 1 day
    assert (r[0].recency, r[0].frequency, r[0].monetary) == (7, 2, 15.0)
    z = segmentation.rfm_scale(segmentation.rfm(items)).first()
    assert (z.recency_z, z.frequency_z, z.monetary_z) == (0.0, 0.0, 0.0)


def test_rfm_all_null_monetary_is_zero(spark):
    items = spark.createDataFrame([("u1", "o1", D(2020, 1, 1), None)],
                                  "customer_unique_id string, order_id string, "
                                  "order_purchase_date date, item_gmv double")
    assert segmentation.rfm(items, as_of="2020-01-11").first().monetary == 0.0
    assert segmentation.rfm(items, as_of="2020-01-11").first().recency == 10


def test_sample_larger_than_table_returns_all(spark):
    df = spark.createDataFrame([(str(i),) for i in range(5)], "k string")
    assert sampling.sample_exact_n(df, 10, ["k"]).count() == 5


def test_sample_exact_size_and_deterministic(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    a = sorted(r.k for r in sampling.sample_exact_n(df, 123, ["k"]).collect())
    b = sorted(r.k for r in sampling.sample_exact_n(df.repartition(7), 123, ["k"]).collect())
    assert len(a) == 123 and a == b
    brute = sorted(df.withColumn("h", F.md5(F.concat(F.lit("42:"), "k")))
                   .orderBy("h").limit(123).toPandas().k)
    assert a == brute


def test_manifest_check_lists_all_missing(spark, tmp_path):
    from martwright.sources.csv_files import assert_files
    (tmp_path / "olist_orders_dataset.csv").write_text("order_id\n1\n")
    with pytest.raises(FileNotFoundError) as e:
        assert_files(spark, str(tmp_path))
    msg = str(e.value)
    assert "olist_order_items_dataset.csv" in msg and "product_category_name_translation.csv" in msg
    assert "olist_orders_dataset.csv" not in msg


def test_null_order_ids_match_nothing(spark):
    items, orders = _item_mart(
        spark, [None, None, "o1", "o2"],
        [(None, "c1", "delivered", T(2020, 1, 1), None, None)] * 3
        + [("o1", "c1", "delivered", T(2020, 1, 2), None, None)],
        [("o1", 5.0, 1, "boleto"), (None, 7.0, 2, "voucher")], [("o2", 4.0), (None, 1.0)])
    rows = {r.order_item_id: r for r in items.collect()}
    assert len(rows) == 4
    assert all(rows[k].order_status is None and rows[k].payment_value_total is None
               and rows[k].review_score_avg is None for k in (0, 1))
    assert (rows[2].payment_value_total, rows[2].customer_state) == (5.0, "S")
    assert (rows[3].review_score_avg, rows[3].order_status) == (4.0, None)
    got = orders.collect()
    assert len(got) == 4 and sum(r.order_id is None for r in got) == 3
    assert [r.payment_value_total for r in got if r.order_id is None] == [None] * 3


@pytest.mark.parametrize("line", ["o1,1,boleto\n", "o1,1,boleto,2,3.5,extra\n"])
def test_csv_rows_of_wrong_length_fail_the_load(spark, tmp_path, line):
    from martwright.sources.csv_files import scan_csv
    p = tmp_path / "payments.csv"
    p.write_text("order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
                 "o1,1,boleto,2,3.5\n" + line)
    with pytest.raises(Exception, match="MALFORMED"):
        scan_csv(spark, str(p), "payments").collect()
    with pytest.raises(Exception, match="MALFORMED"):
        scan_csv(spark, str(p), "payments").select("order_id").collect()


def test_half_counts_round_to_even(spark):
    raw = spark.createDataFrame([(str(x),) for x in ("0.5", "1.5", "2.5", "58.0", "-0.5")], "n string")
    cols = ["product_id", "product_category_name", "product_description_lenght", "product_photos_qty",
            "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
    raw = raw.select(F.col("n").alias("product_name_lenght"), *[F.lit(None).cast("string").alias(c) for c in cols])
    assert [r.product_name_length for r in staging.stage_products(raw).collect()] == [0, 2, 2, 58, 0]


def test_series_with_a_null_key_are_forecast_like_others(spark):
    from martwright.operators import features, forecasting
    rows = [(k, D(2020, 1, 1) + dt.timedelta(days=i), float(i + (10 if k is None else 0)), 1, 1)
            for k in ("A", None) for i in range(40)]
    rows += [("short", D(2020, 1, 1) + dt.timedelta(days=i), 1.0, 1, 1) for i in range(5)]
    daily = spark.createDataFrame(rows, "k string, ds date, y double, orders bigint, items bigint")
    got = {r.k: r.yhat for r in features.forecast_flat(daily, 3, 7, ["k"]).collect()}
    assert got == {"A": 36.0, None: 46.0, "short": 1.0}
    res = forecasting.train_seasonal(daily, test_days=10, series_keys=["k"])
    scored = {r.k: r.n for r in res.predictions.groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert scored == {"A": 10, None: 10, "short": 5}


def test_reviews_csv_with_multiline_comments_and_extra_columns(spark, tmp_path):
    from martwright.sources.csv_files import scan_csv
    p = tmp_path / "reviews.csv"
    p.write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,,"great, fast\nsecond line ""quoted""",2018-01-18 00:00:00,2018-01-18 21:46:59\n'
        "r2,o2,1,bad,,2018-03-10 00:00:00,\n")
    raw = scan_csv(spark, str(p), "reviews")
    assert raw.columns == ["review_id", "order_id", "review_score", "review_creation_date",
                           "review_answer_timestamp"]
    rows = {r.review_id: r for r in staging.stage_reviews(raw).collect()}
    assert rows["r1"].review_score == 5 and rows["r1"].review_answer_ts == T(2018, 1, 18, 21, 46, 59)
    assert rows["r2"].review_answer_ts is None and rows["r2"].review_creation_ts == T(2018, 3, 10)


def test_csv_missing_required_column_is_reported(spark, tmp_path):
    from martwright.sources.csv_files import scan_csv
    p = tmp_path / "sellers.csv"
    p.write_text("seller_id,seller_city\ns1,x\n")
    with pytest.raises(ValueError, match="seller_zip_code_prefix"):
        scan_csv(spark, str(p), "sellers")


@pytest.mark.parametrize("name", ["orders", "order_items", "payments", "reviews", "customers",
                                  "products", "sellers", "geolocation", "category_translation"])
def test_staged_tables_match_their_contract(spark, sf_small, name):
    import __spark_entry__ as entry
    from martwright.schemas import STAGED
    got = entry.queries()[f"stg_{name}"](spark, sf_small).schema
    assert [(f.name, f.dataType) for f in got.fields] == \
        [(f.name, f.dataType) for f in STAGED[name].fields]


def test_to_numeric_turns_bad_text_into_null(spark):
    from martwright.functions import to_numeric
    rows = [("1.5", 1.5), (" 2 ", 2.0), ("1e3", 1000.0), ("-0", 0.0), ("", None), ("abc", None), ("1,5", None),
            ("nan", None), ("NaN", None), ("Infinity", None), (None, None), ("12 BRL", None)]
    df = spark.createDataFrame(rows, "t string, want double").withColumn("got", to_numeric("t"))
    assert [(r.t, r.got) for r in df.collect()] == rows
    assert spark.range(1).select(to_numeric(F.col("id"))).first()[0] == 0.0


def test_best_weekday_tie_is_the_first_of_the_week(spark):
    import datetime as dt

    from martwright.operators.insights import best_weekday
    # Tuesday and Friday are equal; Friday comes first in the alphabet, Tuesday in the week
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), 9.0 if i % 7 in (1, 4) else 1.0) for i in range(14)]
    assert best_weekday(spark.createDataFrame(rows, "ds date, y double")).first().weekday == "Tuesday"


@pytest.mark.parametrize("rows", [700, 50_300])
def test_geolocation_sample_takes_all_points_up_to_the_jobs_size(spark, tmp_path, rows):
    from pyspark.sql import functions as F
    from martwright.plans.registry import queries
    spark.range(rows).select((F.col("id") % 5).cast("int").alias("c_nationkey"),
                             (F.col("id") % 900 / 8).alias("c_acctbal")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(4).selectExpr("CAST(id AS INT) n_nationkey", "'N' || id AS n_name", "CAST(id % 2 AS INT) n_regionkey"
                              ).write.parquet(f"{tmp_path}/nation.parquet")
    spark.sql("SELECT 0 AS r_regionkey, 'R' AS r_name").write.parquet(f"{tmp_path}/region.parquet")
    assert queries()["sample_geolocation"](spark, str(tmp_path)).count() == min(rows, 50_000)


@pytest.mark.parametrize("eol", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("block", [64, 700, 1 << 20])
def test_reviews_are_read_by_blocks_as_by_one_task(spark, tmp_path, monkeypatch, eol, block):
    """Quoted line breaks, quotes and commas, stray quotes, empty lines, records over many blocks."""
    import random

    from martwright.schemas import RAW_COLUMNS
    from martwright.sources.csv_files import scan_csv
    rng = random.Random(block)
    texts = ["", "plain", '"a, b"', f'"two{eol}lines"', f'"{eol}{eol}"', '"say ""so"" now"', f'"""{eol}"""', '5" pipe', 'a"b"c',
             f'"ends""{eol}""begins, ""{eol}"', f'"{f"long,{eol}" * 60}"', '"a"b', '""', '" "', f'"caf\u00e9 {eol}\u65e5"', '"x"']
    lines = ["review_id,order_id,review_score,title,message,review_creation_date,review_answer_timestamp"]
    for i in range(400):
        lines.append(f"r{i},o{i},{i % 5},{rng.choice(texts)},{rng.choice(texts)},2018-01-18,{rng.choice(texts)}")
        if i % 50 == 7:
            lines.append("")
    (tmp_path / "f.csv").write_bytes((eol.join(lines) + eol).encode())
    want = (spark.read.option("header", True).option("escape", '"').option("multiLine", True).option("mode", "FAILFAST")
            .csv(f"{tmp_path}/f.csv").select(*RAW_COLUMNS["reviews"]).collect())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        df = scan_csv(spark, f"{tmp_path}/f.csv", "reviews")
        assert df.rdd.getNumPartitions() > 1 or block > 700 or eol == "\r"
        got = df.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 400 and sorted(map(repr, got)) == sorted(map(repr, want))
