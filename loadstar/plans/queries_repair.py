"""Queries for deliveries and tables that are not well-formed: mixed headers,
quoted line breaks, reruns, late changes, exact images, extreme medians, and
the record a load leaves."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import cdc, clean, quality
from ..session import scratch_path, stage
from ..sinks.export import export_csv
from ..sinks.files import archive_file
from ..sinks.lake import load_run, row_count, table_exists
from ..sources.csv import list_files, read_csv, read_directory, read_source
from ..streaming import ingest
from . import lens
from .lens import SQL_DIRTY, SQL_RAW, SQL_SALES
from .loadjob import run
from .queries_clean import SQL_REASONS, _split_rules
from .queries_load import LENS_JOB, RELOAD_SPLIT
from .registry import ORACLE, register

_SPLIT_TS = f"TIMESTAMP '{RELOAD_SPLIT:%Y-%m-%d %H:%M:%S}'"


def _mixed_delivery(spark, sf_dir) -> str:
    """Raw rows in two groups of files: other columns, in another order; notes
    with doubled quotes and line breaks; prices missing as ``NA``; and rows
    with a field too many (kept apart) or too few (padded)."""
    raw = lens.raw_sales(spark, sf_dir).withColumns({
        "note": F.concat(F.lit('a "b",\nc '), "product_category"),
        "price": F.coalesce("price", F.lit("NA"))})
    d = scratch_path(spark, "mixed-headers")
    export_csv(raw.filter("_row % 2 = 0").select(
        "order_id", "line_no", "price", "note"), d + "/a")
    export_csv(raw.filter("_row % 2 = 1").select(
        "note", "price", "customer_id", "line_no", "order_id"), d + "/b")
    # long and short rows: a file of plain lines under a header of its own
    odd = raw.filter("_row % 97 = 0").select(F.concat_ws(
        ",", "order_id", "line_no", F.when(F.col("_row") % 2 == 0, F.lit("7,x"))
    ).alias("order_id,line_no,price"))
    # one file: only these rows meet in one task, not the joins before them
    odd.repartition(1).write.option("header", True).option(
        "quote", "").option("sep", "\x01").csv(d + "/c")
    return d


def _mixed_files(spark, d: str) -> list[str]:
    return [f for part in "abc"
            for f in list_files(spark, f"{d}/{part}", "part-*.csv")]


_MIXED = f"""
WITH {SQL_RAW},
noted AS (SELECT *, 'a "b",' || chr(10) || 'c ' || product_category AS note
  FROM raw)
SELECT order_id, line_no, price, note, CAST(NULL AS VARCHAR) AS customer_id
FROM noted WHERE _row % 2 = 0
UNION ALL
SELECT order_id, line_no, price, note, customer_id
FROM noted WHERE _row % 2 = 1
UNION ALL
SELECT order_id, line_no, NULL, NULL, NULL
FROM noted WHERE _row % 97 = 0 AND _row % 2 = 1"""


@register("csv_list_mixed_headers", _MIXED)
def csv_list_mixed_headers(spark, sf_dir):
    """A list of files, each read by its own header."""
    files = _mixed_files(spark, _mixed_delivery(spark, sf_dir))
    return read_csv(spark, files).data


@register("csv_malformed_rows", f"""
WITH {SQL_RAW}
SELECT order_id, line_no, order_id || ',' || line_no || ',7,x' AS raw_record
FROM raw WHERE _row % 97 = 0 AND _row % 2 = 0""")
def csv_malformed_rows(spark, sf_dir):
    """S3: the rows with more fields than their header, kept as they came."""
    files = _mixed_files(spark, _mixed_delivery(spark, sf_dir))
    return read_csv(spark, files).malformed.select("order_id", "line_no",
                                                   "raw_record")


@register("ingest_mixed_headers", _MIXED)
def ingest_mixed_headers(spark, sf_dir):
    """The same files as they land, a few in each micro-batch."""
    d = _mixed_delivery(spark, sf_dir)
    base = scratch_path(spark, "ingest-mixed")
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(d + "/all")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(root)
    for i, f in enumerate(_mixed_files(spark, d)):
        fs.rename(jvm.org.apache.hadoop.fs.Path(f),
                  jvm.org.apache.hadoop.fs.Path(root, f"{i:03d}.csv"))
    cols = ["order_id", "line_no", "price", "note", "customer_id"]
    ingest.ingest_available_now(
        spark, d + "/all", cols, base + "/table", base + "/_checkpoint",
        lambda df: df.select(*cols), max_files_per_trigger=3)
    return spark.read.parquet(base + "/table").drop("run_id")


@register("fill_median_extremes", """
WITH v AS (
  SELECT CASE WHEN l_orderkey % 5 = 0 THEN CAST('inf' AS DOUBLE)
              WHEN l_orderkey % 7 = 0 THEN CAST('-inf' AS DOUBLE)
              ELSE CAST(l_extendedprice AS DOUBLE) END AS x,
         CAST(CAST(l_partkey AS HUGEINT) * 10 + l_linenumber AS HUGEINT)
           AS k FROM lineitem),
m AS (SELECT count(*) AS n FROM v),
xs AS (SELECT x, row_number() OVER (ORDER BY x) - 1 AS i FROM v),
ks AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS i FROM v)
SELECT (SELECT avg(x) FROM xs, m WHERE i = (n - 1) // 2 OR i = n // 2)
         AS median_x,
       (SELECT CAST(CASE WHEN count(*) = 1 THEN 2 * sum(k) ELSE sum(k) END
                    AS BIGINT)
        FROM ks, m WHERE i = (n - 1) // 2 OR i = n // 2) AS twice_k""")
def fill_median_extremes(spark, sf_dir):
    """Medians among infinities, and of 38-digit decimals that
    doubles cannot tell apart (the fixed leading digits are taken off again
    for the comparison)."""
    wide = "99999999999999999999999999" + "0" * 12
    li = lens.table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 5 == 0, F.lit(float("inf")))
        .when(F.col("l_orderkey") % 7 == 0, F.lit(float("-inf")))
        .otherwise(F.col("l_extendedprice").cast("double")).alias("x"),
        (F.lit(wide).cast("decimal(38,0)") + (
            F.col("l_partkey") * 10 + F.col("l_linenumber"))
         .cast("decimal(20,0)")).cast("decimal(38,0)").alias("d"))
    x = clean.exact_median(li, "x")
    d = clean.exact_median(li, "d")
    twice = int(2 * (d - int(wide)))
    return li.limit(1).select(F.lit(float(x)).alias("median_x"),
                              F.lit(twice).cast("bigint").alias("twice_k"))


@register("rerun_fewer_rows", f"""
WITH {SQL_SALES}
SELECT * FROM sales WHERE order_date < {_SPLIT_TS}""")
def rerun_fewer_rows(spark, sf_dir):
    """A run loaded again with rows in fewer months leaves none of the
    old ones, nor does a run that is loaded again without any row."""
    s = lens.sales(spark, sf_dir).withColumn(
        "order_month", F.trunc("order_date", "month"))
    target = scratch_path(spark, "rerun")
    month = ["order_month"]
    load_run(s, target, "r1", extra_partitions=month)
    load_run(s.filter(F.col("order_date") < F.lit(RELOAD_SPLIT)), target, "r1",
             extra_partitions=month)
    load_run(s, target, "r2", extra_partitions=month)
    load_run(s.filter("false"), target, "r2", extra_partitions=month)
    return spark.read.parquet(target).drop("run_id", "order_month")


@register("rerun_empty_rejects", f"""
WITH {SQL_SALES}
SELECT 'loaded' AS what, count(DISTINCT order_id) AS row_count FROM sales
UNION ALL SELECT 'rejected', 0""")
def rerun_empty_rejects(spark, sf_dir):
    """A run with rejects, run again on clean rows, has none left."""
    s = lens.sales(spark, sf_dir)
    clean_rows = s.groupBy("order_id").agg(F.min(F.struct(
        *[c for c in s.columns if c != "order_id"])).alias("r")).select(
        "order_id", "r.*").withColumn("price", F.lit("1000"))
    target = scratch_path(spark, "rerun-rejects")
    for rows in (clean_rows.withColumn("price", F.lit("-1")), clean_rows):
        run(spark, rows, LENS_JOB, target, run_id="x",
            reject_target=target + "_rejects")

    def count(path: str):
        return row_count(spark, path, where=F.col("run_id") == "x") \
            if table_exists(spark, path) else 0
    return spark.createDataFrame(
        [("loaded", count(target)), ("rejected", count(target + "_rejects"))],
        "what string, row_count bigint")


@register("cdc_out_of_order")
def cdc_out_of_order(spark, sf_dir):
    """The events of ``cdc_apply_events`` applied in three batches that
    are out of order and share keys; late changes lose, deletes stay."""
    ev = lens.table(spark, sf_dir, "events")
    first = cdc.latest(
        ev.select("user_id", (-F.unix_micros(F.col("ts").cast("timestamp")))
                  .alias("changed_at"), (-F.col("event_id")).alias("change_id"),
                  F.col("event_type").alias("last_event"),
                  F.col("value").alias("last_value")), "user_id")
    state = cdc.with_state(first.select("user_id", "last_event", "last_value"))
    changes = ev.select(
        "user_id", F.col("ts").alias("changed_at"),
        F.col("event_id").alias("change_id"),
        F.when(F.col("event_type") == "error", F.lit(cdc.DELETE))
         .otherwise(F.lit(cdc.UPDATE)).alias("change_type"),
        F.to_json(F.struct("user_id", F.col("event_type").alias("last_event"),
                           F.col("value").alias("last_value")))
         .alias("new_values"))
    for part in (2, 0, 1, 2):          # one of them twice
        state = stage(cdc.apply_changes(state, changes.filter(
            F.col("change_id") % 3 == part), "user_id"), "cdc-state")
    return cdc.visible(state)


ORACLE["cdc_out_of_order"] = ORACLE["cdc_apply_events"]

_EXACT = """
SELECT event_id, CAST(CAST(event_id AS VARCHAR) || '34567890123.0123456789'
         AS DECIMAL(38,10)) AS amount,
       CAST('2020-01-02 03:04:05.' || lpad(CAST(event_id % 1000000 AS VARCHAR),
         6, '0') AS TIMESTAMP) AS seen_at
FROM events WHERE event_type <> 'error'"""


@register("cdc_exact_images", _EXACT)
def cdc_exact_images(spark, sf_dir):
    """Wide decimals and microseconds come back whole from the
    images, by way of the appended change log."""
    ev = lens.table(spark, sf_dir, "events")
    full = ev.select(
        "event_id", F.concat(F.col("event_id").cast("string"), F.lit(
            "34567890123.0123456789")).cast("decimal(38,10)").alias("amount"),
        F.concat(F.lit("2020-01-02 03:04:05."), F.lpad(
            (F.col("event_id") % 1000000).cast("string"), 6, "0"))
        .cast("timestamp_ntz").alias("seen_at"), "event_type")
    new = full.filter("event_type <> 'error'").drop("event_type")
    old = full.filter("event_id % 2 = 0").drop("event_type").withColumn(
        "amount", F.lit(0).cast("decimal(38,10)"))
    log = scratch_path(spark, "change-log")
    cdc.append_changes(cdc.diff(old, new, "event_id", lens.AS_OF), log,
                       "event_id")
    changes = cdc.read_changes(spark, log).withColumnRenamed(
        "order_id", "event_id")
    return cdc.apply_changes(old, changes, "event_id")


@register("load_run_record", f"""
WITH {SQL_RAW},
d AS (SELECT DISTINCT * EXCLUDE (_row) FROM raw),
c AS (SELECT count(*) FILTER (WHERE order_id IS NULL)
    + count(*) FILTER (WHERE line_no IS NULL)
    + count(*) FILTER (WHERE customer_id IS NULL)
    + count(*) FILTER (WHERE order_date IS NULL)
    + count(*) FILTER (WHERE product_id IS NULL)
    + count(*) FILTER (WHERE product_category IS NULL)
    + count(*) FILTER (WHERE price IS NULL)
    + count(*) FILTER (WHERE payment_type IS NULL)
    + count(*) FILTER (WHERE shipping_days IS NULL) AS before,
    count(*) FILTER (WHERE customer_id IS NULL) AS after,
    count(*) AS n FROM d)
SELECT 'PARTIAL' AS status, (SELECT count(*) FROM raw) AS rows_read,
  (SELECT count(*) FROM raw) - n AS duplicates_removed,
  before AS missing_before, after AS missing_after,
  false AS existed, true AS exists_now, true AS archived,
  'sales_load' AS pipeline_name FROM c""")
def load_run_record(spark, sf_dir):
    """What one load run records: its row counts,
    missing cells before and after the fill, whether the table was there,
    and that the delivered files were moved aside."""
    d = scratch_path(spark, "delivery")
    export_csv(lens.raw_sales(spark, sf_dir).drop("_row"), d)
    files = list_files(spark, d, "part-*.csv")
    target = scratch_path(spark, "recorded")
    existed = table_exists(spark, target)
    run(spark, files, LENS_JOB, target, run_id="r1",
        run_log_target=target + "_runlog", archive_dir=target + "_archive")
    moved = len(list_files(spark, target + "_archive", "*")) == len(files) \
        and not list_files(spark, d, "part-*.csv")
    details = F.from_json("execution_details", T.StructType([
        T.StructField(c, T.LongType()) for c in (
            "rows_read", "duplicates_removed", "missing_before",
            "missing_after")]))
    return spark.read.parquet(target + "_runlog").withColumn(
        "d", details).select(
        "status", "d.rows_read", "d.duplicates_removed", "d.missing_before",
        "d.missing_after", F.lit(existed).alias("existed"),
        F.lit(table_exists(spark, target)).alias("exists_now"),
        F.lit(moved).alias("archived"), "pipeline_name")


@register("read_json_parquet", f"WITH {SQL_RAW} SELECT * FROM raw")
def read_json_parquet(spark, sf_dir):
    """Half of the rows as JSON, half as Parquet, through one entry."""
    raw = lens.raw_sales(spark, sf_dir)
    d = scratch_path(spark, "json-parquet")
    raw.filter("_row % 2 = 0").write.json(d + "/json")
    raw.filter("_row % 2 = 1").write.parquet(d + "/parquet")
    return read_source(spark, d + "/json", "json", schema=raw.schema) \
        .unionByName(read_source(spark, d + "/parquet", "parquet"))


ARCHIVED = dt.datetime(2026, 1, 2, 3, 4, 5)
DELIVERIES = 4


@register("archived_source_files", f"""
WITH {SQL_RAW}
SELECT '20260102_030405_delivery' || (_row % {DELIVERIES}) || '.csv'
         AS source_file,
       count(*) AS n, count(customer_id) AS n_customers,
       min(_row) AS first_row, max(_row) AS last_row
FROM raw GROUP BY _row % {DELIVERIES}""")
def archived_source_files(spark, sf_dir):
    """Files moved aside under their stamp; each row of the archive
    names the file it came from."""
    raw = lens.raw_sales(spark, sf_dir)
    d = scratch_path(spark, "archived")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(d).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for k in range(DELIVERIES):
        # one file a delivery: its rows meet in one task, the joins do not
        export_csv(raw.filter(F.col("_row") % DELIVERIES == k)
                   .select("_row", "customer_id").repartition(1), f"{d}/out{k}")
        [part] = list_files(spark, f"{d}/out{k}", "part-*.csv")
        fs.rename(path(part), path(f"{d}/delivery{k}.csv"))
        archive_file(spark, f"{d}/delivery{k}.csv", d + "/archive", ARCHIVED)
    row = F.col("_row").cast("bigint")
    return read_directory(spark, d + "/archive", with_file_name=True).data \
        .groupBy(F.element_at(F.split("_source_file", "/"), -1)
                 .alias("source_file")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("customer_id").alias("n_customers"),
        F.min(row).alias("first_row"), F.max(row).alias("last_row"))


@register("on_error_policies", f"""
WITH {SQL_DIRTY},
n AS (SELECT count(*) AS rejected FROM dirty WHERE {SQL_REASONS} <> '')
SELECT 'halt' AS policy,
       CASE WHEN rejected > 0 THEN 'stopped' ELSE 'went on' END AS outcome,
       rejected FROM n
UNION ALL SELECT 'log_and_continue', 'went on', rejected FROM n""")
def on_error_policies(spark, sf_dir):
    """What each policy does about the rejected rows."""
    _, bad = quality.split(lens.dirty_sales(spark, sf_dir), _split_rules())

    def outcome(policy):
        try:
            quality.enforce_policy(bad, policy)
        except quality.RejectedRowsError:
            return "stopped"
        return "went on"
    return bad.agg(F.count(F.lit(1)).alias("rejected")).select(F.explode(
        F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(outcome(p))
                           .alias("outcome"), "rejected")
                  for p in ("halt", "log_and_continue")])).alias("x")) \
        .select("x.*")
