"""Composite jobs: warehouse build, exports and the sampling job against the oracle."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from scripts.oracle_check import compare, duck_rows, spark_rows


@pytest.mark.parametrize("key", ["run_pipeline", "export_all", "make_sample", "ensure_built", "model_checks",
                                 "rfm_kmeans", "segment_profile", "rfm_scatter_sample", "save_models"])
def test_job_matches_oracle(spark, duck, sf_small, key):
    got = spark_rows(spark, entry.queries()[key], sf_small)
    want = duck_rows(duck, entry.oracle_sql()[key])
    assert compare(got, want) is None


def test_pipeline_preserves_left_rows(spark, sf_small):
    from martwright.plans.warehouse import run_pipeline
    from martwright.session import scratch_path
    from martwright.sources.driver_tables import raw_inputs
    layers = run_pipeline(spark, raw_inputs(spark, sf_small), scratch_path(spark, "wh-test"))
    assert layers.mart["mart_orders"].count() == layers.stg["orders"].count()
    assert layers.mart["mart_order_items"].count() == layers.stg["order_items"].count()
    assert layers.mart["dim_customers"].count() == layers.stg["customers"].count()
    assert layers.mart["dim_products"].count() == layers.stg["products"].count()


def test_csv_raw_dir_roundtrip_builds_same_daily(spark, sf_small):
    """Sample job output (CSV with the required names) is a valid raw input directory."""
    from martwright.operators import staging
    from martwright.operators.marts import item_sales_facts, mart_sales_daily
    from martwright.plans.sample_job import make_sample
    from martwright.session import scratch_path
    from martwright.sources.csv_files import read_raw_dir
    from martwright.sources.driver_tables import raw_inputs
    out = scratch_path(spark, "raw-csv")
    make_sample(spark, raw_inputs(spark, sf_small), out)  # ≤ 15,000 orders: all of sf0.001
    raw = read_raw_dir(spark, out)
    stg = staging.stage_all(raw)
    a = mart_sales_daily(item_sales_facts(stg["order_items"], stg["orders"]))
    q = entry.queries()["mart_sales_daily"](spark, sf_small)
    got = sorted((r.ds, round(r.y, 2), r.orders, r.items) for r in a.collect())
    want = sorted((r.ds, r.y, r.orders, r.items) for r in q.collect())
    assert got == want


def test_cli_build_and_pages(spark, sf_small):
    from martwright.__main__ import main
    from martwright.plans.app import open_marts, pages
    from martwright.session import scratch_path
    wh = scratch_path(spark, "cli-wh")
    assert main(["build", "--driver-tables", sf_small, "--warehouse", wh]) == 0
    marts = open_marts(spark, wh)
    p = pages(spark, marts)
    assert set(p) == {"overview", "sales", "forecast", "insights", "data_health"}
    assert p["forecast"]["flat"].count() == 60
    assert p["sales"]["state_sales"].count() <= 20
    counts = {r.t: r.rows for r in p["data_health"]["row_counts"].collect()}
    assert counts["mart_order_items"] == entry.queries()["stg_order_items"](spark, sf_small).count()


def test_pipeline_refresh_is_idempotent_and_ensure_built_reuses(spark, sf_small):
    from martwright.plans.app import ensure_built, warehouse_exists
    from martwright.plans.warehouse import run_pipeline
    from martwright.session import scratch_path
    from martwright.sources.driver_tables import raw_inputs
    root = scratch_path(spark, "wh-idem")
    first = run_pipeline(spark, raw_inputs(spark, sf_small), root)
    a = {k: v.count() for k, v in first.mart.items()}
    daily_a = sorted(tuple(r) for r in first.mart["mart_sales_daily"].collect())
    second = run_pipeline(spark, raw_inputs(spark, sf_small), root)  # full refresh, same root
    assert {k: v.count() for k, v in second.mart.items()} == a
    assert sorted(tuple(r) for r in second.mart["mart_sales_daily"].collect()) == daily_a
    assert warehouse_exists(spark, root)
    def no_build():
        raise AssertionError("an existing warehouse must not be rebuilt")
    marts = ensure_built(spark, no_build, root)
    assert marts["mart_sales_daily"].count() == a["mart_sales_daily"]


def test_persist_raw_and_stg_layers(spark, sf_small):
    from martwright.plans.warehouse import run_pipeline
    from martwright.session import scratch_path
    from martwright.sinks.tables import current_version
    from martwright.sources.driver_tables import raw_inputs
    root = scratch_path(spark, "wh-layers")
    layers = run_pipeline(spark, raw_inputs(spark, sf_small), root, persist_stg=True,
                          persist_raw=True)
    version = current_version(spark, root)
    assert spark.read.parquet(f"{version}/raw/orders").count() == 1500
    assert spark.read.parquet(f"{version}/stg/order_items").count() == 6000
    assert layers.mart["mart_order_items"].count() == 6000


def test_stored_scaler_scores_new_customers(spark):
    from martwright.operators import segmentation
    train = spark.createDataFrame([("a", 1, 1, 10.0), ("b", 3, 3, 30.0)],
                                  "customer_unique_id string, recency bigint, frequency bigint, "
                                  "monetary double")
    stats = segmentation.scaling_stats(train)
    new = spark.createDataFrame([("c", 2, 2, 20.0)], "customer_unique_id string, "
                                "recency bigint, frequency bigint, monetary double")
    z = segmentation.rfm_scale(new, stats=stats).first()
    assert (z.recency_z, z.frequency_z, z.monetary_z) == (0.0, 0.0, 0.0)


def test_cli_export_and_sample(spark, sf_small):
    from martwright.__main__ import main
    from martwright.schemas import REQUIRED_FILES
    from martwright.session import scratch_path
    from martwright.sinks.exports import EXPORT_TABLES
    wh, exp, smp = (scratch_path(spark, n) for n in ("cli-wh2", "cli-exp", "cli-smp"))
    assert main(["build", "--driver-tables", sf_small, "--warehouse", wh]) == 0
    assert main(["export", "--warehouse", wh, "--out", exp]) == 0
    for t in EXPORT_TABLES:
        assert spark.read.option("header", True).csv(f"{exp}/{t}.csv").count() > 0
    assert main(["sample", "--driver-tables", sf_small, "--out", smp, "--orders", "300"]) == 0
    orders = spark.read.option("header", True).csv(f"{smp}/{REQUIRED_FILES['orders']}")
    items = spark.read.option("header", True).csv(f"{smp}/{REQUIRED_FILES['order_items']}")
    assert orders.count() == 300
    assert items.join(orders, "order_id", "left_anti").count() == 0  # referentially consistent


def test_month_partitioned_marts_prune(spark, sf_small):
    import os
    from pyspark.sql import functions as F
    from martwright.plans.warehouse import run_pipeline
    from martwright.session import scratch_path
    from martwright.sources.driver_tables import raw_inputs
    root = scratch_path(spark, "wh-month")
    layers = run_pipeline(spark, raw_inputs(spark, sf_small), root, month_buckets=4)
    items = layers.mart["mart_order_items"]
    assert items.count() == 6000
    from martwright.sinks.tables import current_version
    path = current_version(spark, root).replace("file:", "") + "/mart/mart_order_items"
    assert any(d.startswith("order_purchase_month=") for d in os.listdir(path))
    one = items.where(F.col("order_purchase_month") == F.lit("1997-05-01").cast("date"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_purchase_month" in plan
    expect = items.where(F.trunc("order_purchase_date", "month") ==
                         F.lit("1997-05-01").cast("date")).count()
    assert one.count() == expect
    # the daily mart built from the partitioned item mart is unchanged
    import __spark_entry__ as entry
    want = sorted((r.ds, r.orders, r.items) for r in
                  entry.queries()["mart_sales_daily"](spark, sf_small).collect())
    got = sorted((r.ds, r.orders, r.items) for r in layers.mart["mart_sales_daily"].collect())
    assert got == want


def test_a_refresh_that_dies_leaves_the_old_marts(spark, sf_small, monkeypatch):
    """Killed in the middle of the marts: readers still get the old version, whole."""
    from martwright.operators import marts as mart_operators
    from martwright.plans.app import open_marts, warehouse_exists
    from martwright.plans.warehouse import run_pipeline
    from martwright.session import scratch_path
    from martwright.sinks.tables import current_version, list_names, versions
    from martwright.sources.driver_tables import raw_inputs
    root = scratch_path(spark, "wh-died")
    assert not warehouse_exists(spark, root)
    run_pipeline(spark, raw_inputs(spark, sf_small), root)
    first, old = current_version(spark, root), open_marts(spark, root)
    want = {name: df.count() for name, df in old.items()}

    def dies(*_args):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(mart_operators, "mart_order_items", dies)
        with pytest.raises(RuntimeError):
            run_pipeline(spark, raw_inputs(spark, sf_small), root)
    assert current_version(spark, root) == first and len(versions(spark, root)) == 1
    assert {name: df.count() for name, df in open_marts(spark, root).items()} == want
    # the next refresh succeeds; whoever opened the old marts can go on reading them
    run_pipeline(spark, raw_inputs(spark, sf_small), root)
    assert current_version(spark, root) != first
    assert {name: df.count() for name, df in old.items()} == want
    # a third one releases the first version, and the folder that the dead build left
    run_pipeline(spark, raw_inputs(spark, sf_small), root)
    kept = [n for n in list_names(spark, root) if n.startswith("v-")]
    assert kept == versions(spark, root) and len(kept) == 2 and first.rsplit("/", 1)[1] not in kept


def test_exports_are_single_files_with_a_header(spark, sf_small):
    import os
    from martwright.plans.context import Context
    from martwright.session import scratch_path
    from martwright.sinks.exports import export_marts, write_csv_file
    from martwright.sinks.tables import list_names
    out = scratch_path(spark, "one-csv")
    df = Context(spark, sf_small).mart("dim_products").repartition(5)
    written = export_marts({"dim_products": df}, out, ["dim_products"])
    path = written["dim_products"].replace("file:", "")
    assert os.path.isfile(path) and list_names(spark, out) == ["dim_products.csv"]
    with open(path) as f:
        lines = f.read().splitlines()
    assert lines[0] == ",".join(df.columns)
    assert len(lines) == 1 + df.count() and lines.count(lines[0]) == 1
    back = spark.read.option("header", True).csv(written["dim_products"])
    assert sorted(r.product_id for r in back.collect()) == sorted(r.product_id for r in df.collect())
    # replaced as a whole; an empty table is its header; odd names are quoted
    odd = spark.createDataFrame([(1, 'a "b", c')], "`x,y` int, z string")
    assert spark.read.option("header", True).option("escape", '"').csv(write_csv_file(odd, path)).columns == ["x,y", "z"]
    write_csv_file(df.where("false"), path)
    with open(path) as f:
        assert f.read() == ",".join(df.columns) + "\n"


def test_memoised_reads_follow_a_refresh(spark, sf_small):
    from martwright.plans.app import memoised_reads
    from martwright.plans.warehouse import run_pipeline
    from martwright.session import scratch_path
    from martwright.sinks.tables import list_names
    from martwright.sources.driver_tables import raw_inputs
    root = scratch_path(spark, "wh-memo")
    raw = raw_inputs(spark, sf_small)
    run_pipeline(spark, raw, root)
    loaders = memoised_reads(spark, root)
    total = loaders.read("kpis").first().total_items
    assert [r.gmv for r in loaders.read("state_sales").collect()] == sorted(
        (r.gmv for r in loaders.read("state_sales").collect()), reverse=True)
    assert loaders.computed == ["kpis", "state_sales"]
    again = memoised_reads(spark, root)  # as another session would
    assert again.read("kpis").first().total_items == total and again.computed == []
    raw["order_items"] = raw["order_items"].where("order_item_id <> '1'")
    run_pipeline(spark, raw, root)
    fresh = memoised_reads(spark, root)
    assert fresh.read("kpis").first().total_items < total and fresh.computed == ["kpis"]
    assert len(list_names(spark, f"{root}/_memo")) == 2
    assert len(fresh.release()) == 1
    assert fresh.read("kpis").first().total_items < total and fresh.computed == ["kpis"]
    assert len(fresh.release(every=True)) == 1 and list_names(spark, f"{root}/_memo") == []
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == 0  # nothing is held in memory


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}


def test_exports_leave_the_disk_to_the_exports(spark, sf_small, monkeypatch):
    """No shuffle file waits for a collection while the files are written; nothing else is left behind."""
    import time
    from martwright.plans import catalog_io
    from martwright.plans.context import Context
    from martwright.session import SHUFFLE_CLEANUP, ensure_checkpoint_dir
    from martwright.sinks.tables import list_names
    real, seen = catalog_io.export_marts, {}

    def export(marts, out):
        until = time.time() + 10  # files go soon after their query, not before its end
        while _shuffle_files(spark) - shuffles and time.time() < until:
            time.sleep(0.1)
        seen["shuffles"] = _shuffle_files(spark) - shuffles
        return real(marts, out)

    monkeypatch.setattr(catalog_io, "export_marts", export)
    ctx = Context(spark, sf_small)
    names, shuffles = set(list_names(spark, ensure_checkpoint_dir(spark))), _shuffle_files(spark)
    rows = {r.t: r["rows"] for r in catalog_io.export_all(ctx).collect()}
    assert set(rows) == set(catalog_io.EXPORT_TABLES) and min(rows.values()) > 0
    assert seen["shuffles"] == set()
    new = set(list_names(spark, ensure_checkpoint_dir(spark))) - names
    assert [n.rsplit("-", 1)[0] for n in new] == ["martwright-exports"]
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"


def test_joined_parts_are_deleted_one_by_one(spark):
    """A part is gone before the next one is read, so the rows are never on the disk twice."""
    import os
    import threading
    from martwright.session import scratch_path
    from martwright.sinks.exports import _join
    top = scratch_path(spark, "parts").replace("file:", "")
    os.makedirs(top)
    texts = {f"part-{i}": f"{i}\n" * 1000 for i in range(4)}
    for name, text in {"joined": "header\n", **texts}.items():
        with open(f"{top}/{name}", "w") as f:
            f.write(text)
    # the last part is a pipe: the join waits for it, while the test looks at the disk
    os.mkfifo(f"{top}/part-4")
    held = []

    def feed():
        with open(f"{top}/part-4", "w") as f:
            held.extend(n for n in sorted(os.listdir(top)) if n in texts)
            f.write("last\n")

    feeder = threading.Thread(target=feed, daemon=True)
    feeder.start()
    _join(spark, f"{top}/joined", [f"{top}/{n}" for n in (*texts, "part-4")])
    feeder.join(10)
    assert held == []
    with open(f"{top}/joined") as f:
        assert f.read() == "header\n" + "".join(texts.values()) + "last\n"
    assert [n for n in os.listdir(top) if not n.endswith(".crc")] == ["joined"]


def test_a_stored_item_mart_gets_its_derived_columns_again(spark):
    from datetime import datetime
    from martwright.operators.marts import ITEM_COLUMNS, ITEM_DERIVED, item_derived
    from martwright.session import scratch_path
    from martwright.sinks.tables import list_names, write_table
    base = {c: "string" for c in ITEM_COLUMNS if c not in ITEM_DERIVED} | {
        "order_item_id": "int", "order_purchase_ts": "timestamp_ntz", "price": "double", "freight_value": "double",
        "payment_value_total": "double", "review_score_avg": "double"}
    odd = [(None, None), (0.1, 0.2), (float("nan"), 1.0), (-0.0, 0.0), (1e308, 1e308), (5.0, None)]
    times = [None, datetime(2018, 1, 1, 23, 59, 59, 999999), datetime(1969, 12, 31, 23), datetime(2020, 2, 29)]
    rows = [tuple({"price": p, "freight_value": f, "order_purchase_ts": t, "order_item_id": i}.get(c, f" {c}," if base[c] == "string" else None)
                  for c in base) for i, (p, f) in enumerate(odd) for t in times]
    whole = item_derived(spark.createDataFrame(rows * 2, ", ".join(f"{c} {t}" for c, t in base.items())))
    path = scratch_path(spark, "items")
    back = item_derived(write_table(spark, whole.drop(*ITEM_DERIVED), path, plain=["price"], codec="zstd"))
    assert back.columns == whole.columns == ITEM_COLUMNS and back.dtypes == whole.dtypes
    assert sorted(map(repr, back.collect())) == sorted(map(repr, whole.collect()))
    assert all(n.endswith(".zstd.parquet") for n in list_names(spark, path) if n.startswith("part-"))
