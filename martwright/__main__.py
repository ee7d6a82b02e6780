"""Command line: the warehouse build, training, export and sampling jobs.

    python -m martwright build   --raw DIR --warehouse DIR [--persist-stg] [--persist-raw]
    python -m martwright train   --warehouse DIR --artifacts DIR [--test-days 60]
    python -m martwright export  --warehouse DIR --out DIR
    python -m martwright sample  --raw DIR --out DIR [--orders 15000] [--geo 50000]
    python -m martwright insights --warehouse DIR

``--raw`` is a folder holding the nine input CSV files (checked up front);
``--driver-tables DIR`` may replace it with the TPC-H-style test tables.
On a cluster, ``spark.checkpoint.dir`` must name a shared folder.
"""

from __future__ import annotations

import argparse
import json
import sys


def _raw(spark, args):
    if getattr(args, "driver_tables", None):
        from martwright.sources.driver_tables import raw_inputs
        return raw_inputs(spark, args.driver_tables)
    from martwright.sources.csv_files import read_raw_dir
    return read_raw_dir(spark, args.raw)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="martwright")
    ap.add_argument("--master", default=None)
    ap.add_argument("--shuffle-partitions", type=int, default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)

    b = sub.add_parser("build")
    b.add_argument("--raw")
    b.add_argument("--driver-tables")
    b.add_argument("--warehouse", required=True)
    b.add_argument("--persist-stg", action="store_true")
    b.add_argument("--persist-raw", action="store_true")
    b.add_argument("--month-buckets", type=int, default=None,
                   help="store order/item marts partitioned by purchase month")

    t = sub.add_parser("train")
    t.add_argument("--warehouse", required=True)
    t.add_argument("--artifacts", required=True)
    t.add_argument("--test-days", type=int, default=60)

    e = sub.add_parser("export")
    e.add_argument("--warehouse", required=True)
    e.add_argument("--out", required=True)

    s = sub.add_parser("sample")
    s.add_argument("--raw")
    s.add_argument("--driver-tables")
    s.add_argument("--out", required=True)
    s.add_argument("--orders", type=int, default=15000)
    s.add_argument("--geo", type=int, default=50000)

    i = sub.add_parser("insights")
    i.add_argument("--warehouse", required=True)

    args = ap.parse_args(argv)

    from martwright.session import build_session
    spark = build_session(args.master, shuffle_partitions=args.shuffle_partitions)

    if args.cmd == "build":
        from martwright.plans.warehouse import run_pipeline
        layers = run_pipeline(spark, _raw(spark, args), args.warehouse,
                              persist_stg=args.persist_stg, persist_raw=args.persist_raw,
                              month_buckets=args.month_buckets)
        print(json.dumps({k: v.count() for k, v in layers.mart.items() if k != "kpi_summary"}))
    elif args.cmd == "train":
        from martwright.plans.app import delivered_extract, open_marts
        from martwright.plans.training import train_all
        marts = open_marts(spark, args.warehouse)
        out = train_all(spark, marts["mart_sales_daily"],
                        delivered_extract(marts["mart_order_items"]), args.artifacts,
                        test_days=args.test_days)
        print(out["metrics"].toJSON().first())
    elif args.cmd == "export":
        from martwright.plans.app import open_marts
        from martwright.sinks.exports import export_marts
        print(json.dumps(export_marts(open_marts(spark, args.warehouse), args.out)))
    elif args.cmd == "sample":
        from martwright.plans.sample_job import make_sample
        print(json.dumps(make_sample(spark, _raw(spark, args), args.out, args.orders, args.geo)))
    elif args.cmd == "insights":
        from martwright.plans.app import insight_page, open_marts
        for r in insight_page(open_marts(spark, args.warehouse)).orderBy("rank").collect():
            print(f"{r['rank']}. {r['insight']}")
    return 0


if __name__ == "__main__":
    code = main()
    from pyspark.sql import SparkSession
    active = SparkSession.getActiveSession()
    if active is not None:
        active.stop()
    sys.exit(code)
