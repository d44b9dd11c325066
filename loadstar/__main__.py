"""Command-line jobs (``spark-submit -m loadstar …`` or ``python -m
loadstar …``): the scheduled load, the quality report, the marts and
exports, and incremental ingestion.

The session comes from the launcher (cluster settings, checkpoint folder);
only the library's semantic settings are applied on top.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    from .session import configure
    return configure(SparkSession.builder.appName("loadstar").getOrCreate())


def _as_of(text: str | None) -> dt.datetime:
    return dt.datetime.fromisoformat(text) if text else dt.datetime.now()


def cmd_load(a) -> int:
    import dataclasses

    from .plans.jobspec import SALES_JOB
    from .plans.loadjob import run
    from .sinks.jdbc import JdbcTarget
    from .session import input_bytes, size_shuffle
    spark = _session()
    size_shuffle(spark, input_bytes(spark, a.input))
    spec = dataclasses.replace(
        SALES_JOB, on_error=a.on_error, csv_multi_line=False if a.single_line else "auto",
        month_partition="order_date" if a.partition_by_month else None)
    target = JdbcTarget(a.jdbc_url, a.jdbc_table,
                        json.loads(a.jdbc_properties or "{}"),
                        atomic=a.jdbc_atomic) \
        if a.jdbc_url else a.target
    res = run(spark, a.input[0] if len(a.input) == 1 else a.input, spec,
              target, run_id=a.run_id, reject_target=a.rejects,
              run_log_target=a.run_log, archive_dir=a.archive,
              quality_log_target=a.quality_log)
    print(json.dumps({"run_id": res.run_id, "status": res.status,
                      "rows_read": res.rows_read,
                      "duplicates_removed": res.duplicates_removed,
                      "rows_loaded": res.rows_loaded,
                      "rows_rejected": res.rows_rejected,
                      "seconds": res.duration_s}))
    return 0


def cmd_report(a) -> int:
    from .functions.values import ts_literal
    from .operators import quality
    from .sinks.lake import write_table
    spark = _session()
    sales = spark.read.parquet(a.table)
    customers = spark.read.parquet(a.customers)
    as_of = _as_of(a.as_of)
    rep = quality.quality_report(sales, customers, as_of)
    write_table(rep.withColumn("checked_at", ts_literal(as_of)), a.out,
                mode="append")
    return 0


def cmd_marts(a) -> int:
    from .operators import marts
    from .sinks.export import export_csv
    from .sinks.lake import write_table
    spark = _session()
    sales = spark.read.parquet(a.table)
    as_of = _as_of(a.as_of)
    for name, df in marts.register_views(sales).items():
        write_table(df, f"{a.out}/{name}", mode="replace")
    export_csv(marts.export_detail(sales, as_of, 30), f"{a.out}/export_30d")
    export_csv(marts.daily_category(sales, as_of, 90),
               f"{a.out}/export_daily_category_90d")
    return 0


def cmd_ingest(a) -> int:
    from .plans.jobspec import SALES_JOB
    from .sources.csv import list_files
    from .streaming.ingest import ingest_runs
    spark = _session()
    files = list_files(spark, a.input)
    if not files:
        print(json.dumps({"batches": []}))
        return 0
    # every file is read by its own header
    print(json.dumps(ingest_runs(
        spark, a.input, SALES_JOB.expected_columns, SALES_JOB, a.target, a.checkpoint,
        reject_target=a.rejects, run_log_target=a.run_log,
        archive_dir=a.archive)))
    return 0


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="loadstar")
    sub = p.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load", help="load CSV files into a table")
    ld.add_argument("input", nargs="+")
    ld.add_argument("--target", help="lake table path")
    ld.add_argument("--jdbc-url")
    ld.add_argument("--jdbc-table", default="sales_transactions")
    ld.add_argument("--jdbc-properties", help="JSON of JDBC options")
    ld.add_argument("--jdbc-atomic", action="store_true",
                    help="stage, then move rows in one transaction")
    ld.add_argument("--rejects")
    ld.add_argument("--run-log")
    ld.add_argument("--quality-log", help="append the run's quality checks")
    ld.add_argument("--archive")
    ld.add_argument("--run-id")
    ld.add_argument("--on-error", default="log_and_continue",
                    choices=["log_and_continue", "halt"])
    ld.add_argument("--partition-by-month", action="store_true",
                    help="also partition the table by order month, so "
                         "recency queries prune whole months")
    ld.add_argument("--single-line", action="store_true",
                    help="records have no quoted line breaks: split large "
                         "files across tasks")
    ld.set_defaults(fn=cmd_load)
    rp = sub.add_parser("report", help="append the quality report")
    rp.add_argument("--table", required=True)
    rp.add_argument("--customers", required=True)
    rp.add_argument("--out", required=True)
    rp.add_argument("--as-of")
    rp.set_defaults(fn=cmd_report)
    mt = sub.add_parser("marts", help="write marts and CSV exports")
    mt.add_argument("--table", required=True)
    mt.add_argument("--out", required=True)
    mt.add_argument("--as-of")
    mt.set_defaults(fn=cmd_marts)
    ig = sub.add_parser("ingest", help="load new files of a folder once")
    ig.add_argument("input")
    ig.add_argument("--target", required=True)
    ig.add_argument("--checkpoint", required=True)
    ig.add_argument("--rejects")
    ig.add_argument("--run-log")
    ig.add_argument("--archive")
    ig.set_defaults(fn=cmd_ingest)
    a = p.parse_args(argv)
    if a.cmd == "load" and not (a.target or a.jdbc_url):
        p.error("load needs --target or --jdbc-url")
    return a.fn(a)


if __name__ == "__main__":
    sys.exit(main())
