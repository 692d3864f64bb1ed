"""Job entry points for spark-submit: ``python -m ordermill <job> ...``.

    load     raw CSV folder -> raw tables (+ quarantine), prints the load report
    daily    staging tables -> marts (written) -> tests and checks, prints them
    ingest   topic or text folder -> landing table (+ quarantine), runs until stopped
    hourly   landing table (as a stream) -> live hourly table (state, recount, update or append mode)
    compact  landed batches of a date range -> date-partitioned orders table
    monitor  landing table -> freshness + spike status; exits non-zero when stale
    dashboard  landing table, or its date-partitioned copy -> the dashboard's panels as JSON lines

Scheduling (daily at 01:00, every five minutes) is left to the caller's
scheduler; each job is one Spark application.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from ordermill.functions.time import PERIODS
from ordermill.session import CLUSTER_CONF, build_session

STAGING_TABLES = ("stg_customers", "stg_orders", "stg_order_items", "stg_order_payments",
                  "stg_order_reviews", "stg_products", "stg_sellers")


def _staging(spark, source: str) -> dict:
    """Staging tables from a folder of Parquet tables or a catalog database."""
    if "/" in source:
        return {n: spark.read.parquet(os.path.join(source, n)) for n in STAGING_TABLES}
    return {n: spark.table(f"{source}.{n}") for n in STAGING_TABLES}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="ordermill")
    p.add_argument("--local", action="store_true", help="local[*] master, small shuffles")
    sub = p.add_subparsers(dest="job", required=True)

    s = sub.add_parser("load")
    s.add_argument("raw_dir")
    s.add_argument("target_root")
    s.add_argument("quarantine_root")
    s.add_argument("--require", action="store_true", help="fail when a required file is missing")

    s = sub.add_parser("daily")
    s.add_argument("staging", help="folder of Parquet staging tables, or a database name")
    s.add_argument("out_root")
    s.add_argument("--fail-on", default="error", help="comma-separated severities that fail")
    s.add_argument("--report-test-failures", action="store_true",
                   help="report failing declared tests instead of stopping the run")

    s = sub.add_parser("ingest")
    s.add_argument("landing")
    s.add_argument("quarantine")
    s.add_argument("checkpoint")
    src = s.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", metavar="BOOTSTRAP_SERVERS")
    src.add_argument("--text-dir")
    s.add_argument("--topic", default="orders")
    s.add_argument("--max-per-trigger", type=int, default=None)
    s.add_argument("--max-bytes", type=int, default=None, help="bytes of text files in one micro-batch")
    s.add_argument("--flush-rows", type=int, default=None, help="most rows of one landed file")
    s.add_argument("--available-now", action="store_true")

    s = sub.add_parser("hourly")
    s.add_argument("landing")
    s.add_argument("out")
    s.add_argument("checkpoint")
    s.add_argument("--mode", choices=("state", "recount", "update", "append"), default="state",
                   help="state and recount are right also for replayed and late batches")
    s.add_argument("--state-partitions", type=int, default=16,
                   help="state store partitions, fixed at the first start")
    s.add_argument("--available-now", action="store_true")

    s = sub.add_parser("compact")
    s.add_argument("landing")
    s.add_argument("table")
    s.add_argument("start_date")
    s.add_argument("end_date")

    s = sub.add_parser("monitor")
    s.add_argument("landing")

    s = sub.add_parser("dashboard")
    s.add_argument("orders", help="landing table, or the table that compact writes")
    s.add_argument("--period", choices=PERIODS, default="hour", help="period of the top sellers")
    s.add_argument("--as-of", default=None, help="time that counts as now (default: the clock)")

    args = p.parse_args(argv)
    conf = {"spark.sql.shuffle.partitions": "8"} if args.local else dict(CLUSTER_CONF)
    if args.job == "hourly":
        # The state holds one row per hour; its partition count is fixed by
        # the checkpoint at the first start, so keep it small.
        conf["spark.sql.shuffle.partitions"] = str(args.state_partitions)
    spark = build_session("local[*]" if args.local else None, "ordermill-" + args.job, conf)

    if args.job == "load":
        from ordermill.sources import files
        if args.require:
            files.require_inputs(spark, args.raw_dir)
        report = files.load_files(spark, args.raw_dir, args.target_root, args.quarantine_root)
        for r in report.collect():
            print(json.dumps(r.asDict()))
    elif args.job == "daily":
        from ordermill.plans import daily
        fail_on = tuple(x for x in args.fail_on.split(",") if x)
        result = daily.run_daily(spark, _staging(spark, args.staging), args.out_root, fail_on,
                                 strict_tests=not args.report_test_failures)
        for part in (result.row_counts, result.column_tests, result.report):
            for r in part.collect():
                print(json.dumps(r.asDict(), default=str))
    elif args.job == "ingest":
        from ordermill.streaming import ingest
        source = (ingest.kafka_order_source(spark, args.kafka, args.topic,
                                            args.max_per_trigger or 1_000_000)
                  if args.kafka else
                  ingest.text_order_source(spark, args.text_dir, args.max_per_trigger, args.max_bytes))
        sink = ingest.LandingSink(args.landing, args.quarantine, args.checkpoint, flush_rows=args.flush_rows)
        sink.start(source, available_now=args.available_now).awaitTermination()
    elif args.job == "hourly":
        from ordermill.streaming import hour_state, hourly, ingest
        if args.mode in ("state", "recount"):
            start = hour_state.start_hourly_state if args.mode == "state" else hourly.start_hourly_recount
            query = start(spark, args.landing, args.out, args.checkpoint, available_now=args.available_now)
        else:
            stream = hourly.hourly_stream(ingest.landing_stream(spark, args.landing))
            start = (hourly.start_hourly_updates if args.mode == "update"
                     else hourly.start_hourly_append)
            query = start(stream, args.out, args.checkpoint, available_now=args.available_now)
        query.awaitTermination()
    elif args.job == "compact":
        from ordermill.streaming import ingest
        ingest.compact_landing(spark, args.landing, args.table, args.start_date, args.end_date)
    elif args.job == "monitor":
        from ordermill.plans.monitor import health_check
        from ordermill.streaming import ingest
        try:
            print(json.dumps(health_check(ingest.read_landing(spark, args.landing))))
        except ValueError as e:
            print(f"ALERT: {e}", file=sys.stderr)
            return 1
    elif args.job == "dashboard":
        from ordermill.plans import dashboard
        from ordermill.sources import files
        from ordermill.streaming import ingest
        dates = files.partition_values(spark, args.orders, "order_date")
        orders = spark.read.parquet(args.orders) if dates else ingest.read_landing(spark, args.orders)
        for r in dashboard.as_rows(dashboard.panels(orders, args.as_of, args.period, dates)).collect():
            print(json.dumps(r.asDict()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
