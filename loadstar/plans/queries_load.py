"""Load, ingest, export and run-log queries (S1, S4, S5, S8, S10, S15-S18,
M1, M2, M4, M5, T1, T2). Inputs are files Spark writes from the lens into
the session's checkpoint folder; results are read back from the sinks."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from ..functions.rules import range_rule
from ..operators import cdc, clean, marts, quality, runlog
from ..session import drop_path, scratch_path
from ..sinks.export import export_csv
from ..sinks.lake import load_run
from ..sources.csv import (DELIVERED, list_files, read_directory, read_files,
                           splittable)
from ..streaming import buckets, ingest
from . import lens
from .jobspec import SALES_JOB
from .lens import AS_OF, SQL_RAW, SQL_SALES
from .loadjob import run
from .queries_cdc import SQL_SNAPSHOTS, snapshots
from .queries_clean import RAW_COLS, dt as sql_dt, num as sql_num
from .registry import ORACLE, register

# of an order's lines the first is the one the table's key admits
LENS_JOB = replace(SALES_JOB, key_order=("line_no", "product_id", "price",
                                           "shipping_days"))
RELOAD_SPLIT = dt.datetime(1998, 1, 1)     # runs r1 (before) and r2 (after)
CHANGE_BATCHES = 6       # micro-batches in which a stream of changes comes


def _raw_csv_dir(spark, sf_dir):
    d = scratch_path(spark, "raw-sales-csv")
    export_csv(lens.raw_sales(spark, sf_dir), d)
    return d


def _raw_run(spark, sf_dir, target, **kw):
    """The load run on the raw CSV, which is delivered compressed and goes
    when the run has ended. Returns the run's result."""
    d = scratch_path(spark, "raw-sales-csv")
    try:
        export_csv(lens.raw_sales(spark, sf_dir), d, compression="gzip")
        src = read_directory(spark, d, pattern="part-*.csv.gz")
        return run(spark, src.data, LENS_JOB, target, run_id="r1",
                   reject_target=target + "_rejects", order_by=["_row"], **kw)
    finally:
        drop_path(spark, d)


@register("csv_extract", f"""
WITH {SQL_RAW}
SELECT * REPLACE (CAST(_row AS VARCHAR) AS _row) FROM raw""")
def csv_extract(spark, sf_dir):
    """The raw rows written as CSV and read back as text."""
    return read_directory(spark, _raw_csv_dir(spark, sf_dir),
                          pattern="part-*.csv").data


@register("csv_directory_union", f"""
WITH {SQL_RAW}
SELECT order_id, line_no, price, customer_id FROM raw WHERE _row % 2 = 0
UNION ALL BY NAME
SELECT order_id, line_no, price, order_date FROM raw WHERE _row % 2 = 1""")
def csv_directory_union(spark, sf_dir):
    """One folder holding files with two different headers."""
    raw = lens.raw_sales(spark, sf_dir)
    d = scratch_path(spark, "mixed-csv")
    export_csv(raw.filter(F.col("_row") % 2 == 0).select(
        "order_id", "line_no", "price", "customer_id"), d + "/even")
    export_csv(raw.filter(F.col("_row") % 2 == 1).select(
        "order_id", "line_no", "price", "order_date"), d + "/odd")
    # gather both exports into one folder (file moves, no data copy)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(d + "/all")
    fs = root.getFileSystem(conf)
    fs.mkdirs(root)
    for part in ("even", "odd"):
        for st in fs.globStatus(jvm.org.apache.hadoop.fs.Path(
                f"{d}/{part}/part-*.csv")):
            fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(
                root, f"{part}-{st.getPath().getName()}"))
    return read_directory(spark, d + "/all").data


@register("csv_split_files", f"""
WITH {SQL_RAW}
SELECT order_id, CAST(line_no AS VARCHAR) AS line_no,
  CASE WHEN _row % 2 = 0 THEN customer_id || ', "x"'
    ELSE customer_id || chr(10) || 'y' END AS customer_id,
  CAST(_row % 2 = 1 AS BOOLEAN) AS whole
FROM raw""")
def csv_split_files(spark, sf_dir):
    """Of two deliveries with quoted text only the one with quoted
    line breaks (``whole``) is left to the reader that cannot split files."""
    raw = lens.raw_sales(spark, sf_dir)
    who, odd = F.col("customer_id").cast("string"), F.col("_row") % 2 == 1
    d = scratch_path(spark, "quoted-csv")
    for name, rows, text in (
            ("plain", ~odd, F.concat(who, F.lit(', "x"'))),
            ("broken", odd, F.concat(who, F.lit("\ny")))):
        export_csv(raw.filter(rows).select(
            "order_id", "line_no", text.alias("customer_id")), f"{d}/{name}")
    files = [f for name in ("plain", "broken")
             for f in list_files(spark, f"{d}/{name}", "part-*.csv")]
    split = splittable(spark, files, split_bytes=0)
    read = read_files(spark, files, split_bytes=0, with_order=True)
    names = spark.createDataFrame([(f.rsplit("/", 1)[-1],) for f in sorted(split)],
                                  "name string")
    got = read.data.withColumn("name", F.element_at(F.split(
        DELIVERED[0], "/"), -1))
    return got.join(names.withColumn("_split", F.lit(True)), "name", "left") \
        .select("order_id", "line_no", "customer_id",
                F.col("_split").isNull().alias("whole"))


@register("load_append_verify")
def load_append_verify(spark, sf_dir):
    """The full load run on the raw CSV with the table's
    constraints, read back from the lake table."""
    target = scratch_path(spark, "sales-table")
    res = _raw_run(spark, sf_dir, target, run_log_target=target + "_runlog")
    if res.status not in ("SUCCESS", "PARTIAL"):
        raise RuntimeError(f"load failed: {res}")
    return _admitted(spark.read.parquet(target))


@register("idempotent_reload", f"""
WITH {SQL_SALES}
SELECT *, CASE WHEN order_date < TIMESTAMP '{RELOAD_SPLIT:%Y-%m-%d %H:%M:%S}'
               THEN 'r1' ELSE 'r2' END AS run_id
FROM sales""")
def idempotent_reload(spark, sf_dir):
    """Run r1 loaded twice and r2 once leave r1's rows once."""
    s = lens.sales(spark, sf_dir)
    target = scratch_path(spark, "reload")
    early = F.col("order_date") < F.lit(RELOAD_SPLIT)
    load_run(s.filter(early), target, "r1")
    load_run(s.filter(early), target, "r1")
    load_run(s.filter(~early), target, "r2")
    return spark.read.parquet(target)


SQL_RUNS = """runs AS (
  SELECT CAST(user_id AS VARCHAR) || '-' || strftime(CAST(ts AS DATE), '%Y%m%d')
           AS execution_id,
         'pipeline_' || CAST(user_id % 15 AS VARCHAR) AS pipeline_name,
         min(ts) AS start_time, max(ts) AS end_time,
         count(*) AS rows_processed,
         count(*) FILTER (WHERE event_type = 'error') AS rows_failed
  FROM events GROUP BY user_id, CAST(ts AS DATE)),
runs2 AS (
  SELECT *, CASE WHEN rows_failed = 0 THEN 'SUCCESS'
                 WHEN rows_failed = rows_processed THEN 'FAILED'
                 ELSE 'PARTIAL' END AS status,
         date_sub('second', start_time, end_time) AS d
  FROM runs)"""


@register("run_log_top10", f"""
WITH {SQL_RUNS}
SELECT pipeline_name, count(*) AS calls, CAST(sum(d) AS DOUBLE) AS total_s,
       CAST((sum(d) * 200 + count(*)) // (2 * count(*)) AS DOUBLE) / 100
         AS avg_s,
       min(d) AS min_s, max(d) AS max_s
FROM runs2 GROUP BY pipeline_name
ORDER BY total_s DESC, pipeline_name LIMIT 10""")
def run_log_top10(spark, sf_dir):
    runs = runlog.runs_from_events(lens.table(spark, sf_dir, "events"))
    return runlog.slowest_pipelines(runs)


# the long-run report leaves out the monitoring pipeline itself
MONITOR_PIPELINE_LIKE = "PIPELINE_0"


@register("run_log_long", f"""
WITH {SQL_RUNS}
SELECT execution_id, pipeline_name, start_time, status, d AS duration_seconds
FROM runs2 WHERE d > 300 AND pipeline_name NOT ILIKE '{MONITOR_PIPELINE_LIKE}'
ORDER BY start_time DESC, execution_id""")
def run_log_long(spark, sf_dir):
    runs = runlog.runs_from_events(lens.table(spark, sf_dir, "events"))
    return runlog.long_runs(runs, exclude_like=MONITOR_PIPELINE_LIKE)


@register("export_detail_csv", f"""
WITH {SQL_SALES}
SELECT order_id, CAST(line_no AS VARCHAR) AS line_no, customer_id,
       CAST(order_date AS VARCHAR) AS order_date, product_id,
       product_category, CAST(price AS VARCHAR) AS price, payment_type,
       CAST(shipping_days AS VARCHAR) AS shipping_days
FROM sales WHERE order_date >= TIMESTAMP '2001-07-02 00:00:00'""")
def export_detail_csv(spark, sf_dir):
    """The 30-day export written as CSV, read back as text."""
    d = scratch_path(spark, "export-30d")
    export_csv(marts.export_detail(lens.sales(spark, sf_dir), AS_OF, 30), d)
    return read_directory(spark, d, pattern="part-*.csv").data


def _stream_process(df):
    typed = clean.coerce_types(df, {"order_date": "datetime",
                                    "price": "numeric"})
    good, _ = quality.split(typed, [range_rule("price", 0, 100000)])
    return good


@register("ingest_available_now", f"""
WITH {SQL_RAW}
SELECT order_id, line_no, customer_id, {sql_dt('order_date')} AS order_date,
       product_id, product_category, {sql_num('price')} AS price,
       payment_type, shipping_days, CAST(_row AS VARCHAR) AS _row
FROM raw WHERE {sql_num('price')} BETWEEN 0 AND 100000""")
def ingest_available_now(spark, sf_dir):
    """New CSV files picked up by an availableNow stream in
    several micro-batches, processed by the batch pipeline, archived."""
    src = _raw_csv_dir(spark, sf_dir)
    base = scratch_path(spark, "stream-ingest")
    ingest.ingest_available_now(
        spark, src, list(RAW_COLS) + ["_row"], base + "/table",
        base + "/_checkpoint", _stream_process,
        reject_target=base + "/rejects", archive_dir=base + "/archive",
        max_files_per_trigger=3)
    return spark.read.parquet(base + "/table").drop("run_id")


@register("ingest_runs_one_batch")
def ingest_runs_one_batch(spark, sf_dir):
    """T1 with the whole load job per micro-batch: a delivery folder picked
    up in one availableNow batch is one full load run, so its result is the
    transform chain's (dedupe over the delivered columns)."""
    src = scratch_path(spark, "raw-sales-csv-plain")
    export_csv(lens.raw_sales(spark, sf_dir).drop("_row"), src)
    base = scratch_path(spark, "stream-runs")
    ingest.ingest_runs(spark, src, list(RAW_COLS), LENS_JOB,
                       base + "/table", base + "/_checkpoint",
                       reject_target=base + "/rejects",
                       run_log_target=base + "/runlog")
    return _admitted(spark.read.parquet(base + "/table"))


def _files_a_batch(spark, folder: str) -> int:
    """Files of a micro-batch by which the change files below ``folder`` come
    in about ``CHANGE_BATCHES`` batches. Every batch that touches all buckets
    writes the table once, so one file a batch would cost the table as many
    times as there are files, and both grow."""
    files = sum(len(list_files(spark, folder, f"change_type={kind}/part-*"))
                for kind in (cdc.INSERT, cdc.UPDATE, cdc.DELETE))
    return max(1, -(-files // CHANGE_BATCHES))


@register("stream_change_apply", f"""
WITH {SQL_SNAPSHOTS}
SELECT * FROM new""")
def stream_change_apply(spark, sf_dir):
    """The change log of two snapshots, delivered as JSON files of one
    change kind each, applied micro-batch by micro-batch to the old
    snapshot."""
    old, new = snapshots(spark, sf_dir)
    base = scratch_path(spark, "stream-cdc")
    changes = cdc.diff(old, new, "order_id", AS_OF)
    changes.write.partitionBy("change_type").json(base + "/changes")
    ingest.write_version(old, base + "/table", 0)
    stream = (spark.readStream.schema(changes.schema)
              .option("maxFilesPerTrigger",
                      _files_a_batch(spark, base + "/changes"))
              .json(base + "/changes"))
    ingest.apply_change_stream(
        spark, stream, base + "/table", base + "/_checkpoint",
        lambda cur, chg: cdc.apply_changes(cur, chg, "order_id"))
    return ingest.read_version(spark, base + "/table")


@register("stream_change_apply_buckets", f"""
WITH {SQL_SNAPSHOTS}
SELECT * FROM new""")
def stream_change_apply_buckets(spark, sf_dir):
    """T2 at scale: the same change stream applied bucket by bucket — each
    micro-batch rewrites only the key buckets it touches."""
    old, new = snapshots(spark, sf_dir)
    base = scratch_path(spark, "stream-cdc-buckets")
    changes = cdc.diff(old, new, "order_id", AS_OF)
    changes.write.partitionBy("change_type").json(base + "/changes")
    ingest.write_buckets(old, base + "/table", "order_id", 64)
    stream = (spark.readStream.schema(changes.schema)
              .option("maxFilesPerTrigger",
                      _files_a_batch(spark, base + "/changes"))
              .json(base + "/changes"))
    ingest.apply_change_stream_buckets(
        spark, stream, base + "/table", "order_id", 64, base + "/_checkpoint",
        lambda cur, chg: cdc.apply_changes(cur, chg, "order_id"))
    return ingest.read_buckets(spark, base + "/table")


@register("cdc_apply_buckets", f"""
WITH {SQL_SNAPSHOTS}
SELECT * FROM new""")
def cdc_apply_buckets(spark, sf_dir):
    """C3 on a bucketed table: the change log merged into only the buckets
    it touches."""
    old, new = snapshots(spark, sf_dir)
    base = scratch_path(spark, "cdc-buckets")
    ingest.write_buckets(old, base, "order_id", 64)
    ingest.apply_to_buckets(spark, base, cdc.diff(old, new, "order_id", AS_OF),
                            "order_id", 64,
                            lambda cur, chg: cdc.apply_changes(cur, chg,
                                                               "order_id"))
    return ingest.read_buckets(spark, base)


@register("stream_change_apply_growing", f"""
WITH {SQL_SNAPSHOTS}
SELECT * FROM new""")
def stream_change_apply_growing(spark, sf_dir):
    """The same change stream on a table whose buckets grow; each
    micro-batch is one version, there as a whole or not at all."""
    old, new = snapshots(spark, sf_dir)
    base = scratch_path(spark, "stream-cdc-growing")
    changes = cdc.diff(old, new, "order_id", AS_OF)
    changes.write.partitionBy("change_type").json(base + "/changes")
    buckets.write_table(old, base + "/table", "order_id")
    stream = (spark.readStream.schema(changes.schema)
              .option("maxFilesPerTrigger", 8)
              .json(base + "/changes"))
    buckets.apply_change_stream(
        spark, stream, base + "/table", base + "/_checkpoint",
        lambda cur, chg: cdc.apply_changes(cur, chg, "order_id"))
    return buckets.read_table(spark, base + "/table")


@register("cdc_growing_buckets", f"""
WITH {SQL_SNAPSHOTS}
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS too_large,
  CAST(1 AS DOUBLE) AS hash_space FROM new""")
def cdc_growing_buckets(spark, sf_dir):
    """A table that starts empty and gets every order as a change: all
    rows are in, no bucket is over the size, and the buckets share out the
    whole hash space."""
    _, new = snapshots(spark, sf_dir)
    base, most = scratch_path(spark, "cdc-growing"), 2000
    buckets.write_table(new.limit(0), base, "order_id", most)
    buckets.apply_batch(
        spark, base, cdc.diff(new.limit(0), new, "order_id", AS_OF),
        lambda cur, chg: cdc.apply_changes(cur, chg, "order_id"))
    return buckets.version(spark, base).leaves.agg(
        F.sum("rows").alias("n_rows"),
        F.count_if(F.col("rows") > most).alias("too_large"),
        F.sum(F.pow(F.lit(2.0), -F.col("depth"))).alias("hash_space"))


# What the table's rules say of each row of the transform chain, in order.
SQL_CHECKED = f"""checked AS (
  SELECT *, concat_ws(',',
    CASE WHEN NOT coalesce(price BETWEEN 0 AND 100000, false)
         THEN 'price_range' END,
    CASE WHEN order_id IS NULL THEN 'order_id_not_null' END,
    CASE WHEN customer_id IS NULL THEN 'customer_id_not_null' END,
    CASE WHEN order_date IS NULL THEN 'order_date_not_null' END,
    CASE WHEN product_id IS NULL THEN 'product_id_not_null' END,
    CASE WHEN price IS NULL THEN 'price_not_null' END) AS reasons
  FROM ({{chain}})),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY order_id, reasons = ''
                               ORDER BY line_no, product_id, price,
                                        shipping_days) AS nth FROM checked)"""
_CHAIN = ORACLE["transform_full"].rpartition("SELECT * FROM f")[0]
_CHECKED = SQL_CHECKED.replace("{chain}", "SELECT * FROM f")


def _constrained_run(spark, sf_dir):
    target = scratch_path(spark, "sales-constrained")
    _raw_run(spark, sf_dir, target)
    return target


@register("load_constraints", f"""
{_CHAIN.rstrip()},
{_CHECKED}
SELECT order_id, customer_id, order_date, product_id, product_category,
       CAST(price AS DECIMAL(10,2)) AS price, payment_type,
       CAST(shipping_days AS INTEGER) AS shipping_days,
       true AS stamped, line_no
FROM ranked WHERE reasons = '' AND nth = 1""")
def load_constraints(spark, sf_dir):
    """The rows a load admits to the sales table: every NOT NULL,
    length, magnitude and key constraint holds, columns have the table's
    types, and the two time stamps their default."""
    return _admitted(spark.read.parquet(_constrained_run(spark, sf_dir)))


def _admitted(rows):
    return rows.withColumn("stamped", F.col("created_at").isNotNull()
                           & (F.col("created_at") == F.col("updated_at"))) \
        .drop("created_at", "updated_at", "run_id")


@register("load_constraint_rejects", f"""
{_CHAIN.rstrip()},
{_CHECKED}
SELECT order_id, line_no,
       CASE WHEN reasons = '' THEN 'duplicate_key' ELSE reasons END
         AS reject_reasons
FROM ranked WHERE reasons <> '' OR nth > 1""")
def load_constraint_rejects(spark, sf_dir):
    """The rows the same load rejects, with every reason."""
    return spark.read.parquet(_constrained_run(spark, sf_dir) + "_rejects") \
        .select("order_id", "line_no", "reject_reasons")


# the full load runs admit the same rows
ORACLE["load_append_verify"] = ORACLE["load_constraints"]
ORACLE["ingest_runs_one_batch"] = ORACLE["load_constraints"]
