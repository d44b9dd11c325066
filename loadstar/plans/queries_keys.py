"""Constraints that need other rows, delivery order and datetime layouts
(S12, J2-J4, U2, P3): loads checked against parent tables and earlier runs,
keep-first by the rows' places in files, and layouts found in the data."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions.values import ALL_FORMATS
from ..operators import clean
from ..session import drop_path, input_bytes, scratch_path, stage
from ..sinks.export import export_csv
from ..sources.csv import DELIVERED, read_directory
from . import lens
from .jobspec import JobSpec
from .lens import SQL_ORDER_ITEMS, SQL_RAW, SQL_SALES
from .loadjob import run
from .queries_load import LENS_JOB
from .registry import register

# --- fixed values -----------------------------------------------------------
# Order and part keys that are left out of the parent tables, and orders that
# the first of two runs does not deliver.
HIDDEN_ORDER, HIDDEN_PART, LATER_ORDER = 13, 31, 3
# A permutation of the rows as their order of delivery.
SHUFFLE, WITHIN = 7919, 10007
# Bytes of the lineitem table whose rows are delivered in one file.
FILE_INPUT = 16 << 20
# ---------------------------------------------------------------------------

ITEMS_JOB = JobSpec(name="order_items_load", table="order_items",
                    fill_exclude=("order_id", "product_id"))


def _items_run(spark, sf_dir):
    orders = lens.table(spark, sf_dir, "orders").filter(
        F.col("o_orderkey") % HIDDEN_ORDER != 0).select(
        F.col("o_orderkey").cast("string").alias("order_id"))
    products = lens.products(spark, sf_dir).filter(
        F.col("product_id").cast("long") % HIDDEN_PART != 0)
    target = scratch_path(spark, "order-items")
    run(spark, lens.order_items(spark, sf_dir), ITEMS_JOB, target,
        run_id="r1", reject_target=target + "_rejects",
        parents={"sales_transactions": orders, "products": products})
    return target


_ITEMS = f"""
WITH {SQL_ORDER_ITEMS},
i AS (SELECT *, CAST(order_id AS BIGINT) % {HIDDEN_ORDER} = 0
             OR CAST(order_id AS BIGINT) NOT IN
               (SELECT o_orderkey FROM orders) AS no_order,
             CAST(product_id AS BIGINT) % {HIDDEN_PART} = 0
             OR CAST(product_id AS BIGINT) NOT IN
               (SELECT p_partkey FROM part) AS no_product
      FROM (SELECT DISTINCT * FROM order_items))"""


@register("load_fk_rejects", f"""{_ITEMS}
SELECT order_id, line_no, product_id, quantity,
       CASE WHEN no_order THEN 'order_id_not_in_sales_transactions'
            ELSE 'product_id_not_in_products' END AS reject_reasons
FROM i WHERE no_order OR no_product""")
def load_fk_rejects(spark, sf_dir):
    """Rows of a load whose order or product is not in the parent
    table, with the first reference that fails."""
    return spark.read.parquet(_items_run(spark, sf_dir) + "_rejects").select(
        "order_id", "line_no", "product_id", "quantity", "reject_reasons")


@register("load_fk_rows", f"""{_ITEMS}
SELECT order_id, line_no, product_id, quantity, total_price
FROM i WHERE NOT no_order AND NOT no_product""")
def load_fk_rows(spark, sf_dir):
    """The rows that the same load admits."""
    return spark.read.parquet(_items_run(spark, sf_dir)).select(
        "order_id", "line_no", "product_id", "quantity", "total_price")


def _two_runs(spark, sf_dir):
    target, path = (scratch_path(spark, "two-runs"),
                    scratch_path(spark, "delivered-sales"))
    try:
        # the joins run once and not for each of the three runs
        s = stage(lens.sales(spark, sf_dir), path=path)
        first = s.filter(F.col("order_id").cast("long") % LATER_ORDER != 0)
        for run_id, rows in (("r1", first), ("r2", s), ("r1", first)):
            run(spark, rows, LENS_JOB, target, run_id=run_id,
                reject_target=target + "_rejects")
    finally:
        drop_path(spark, path)
    return target


@register("load_keys_across_runs", f"""
WITH {SQL_SALES}
SELECT DISTINCT order_id, CASE WHEN CAST(order_id AS BIGINT) % {LATER_ORDER}
  <> 0 THEN 'r1' ELSE 'r2' END AS run_id FROM sales
WHERE price BETWEEN 0 AND 100000""")
def load_keys_across_runs(spark, sf_dir):
    """A key that one run has loaded stays with that run, also when
    the run is loaded again after another."""
    return spark.read.parquet(_two_runs(spark, sf_dir)).select("order_id",
                                                               "run_id")


@register("load_key_rejects", f"""
WITH {SQL_SALES},
s AS (SELECT DISTINCT * FROM sales WHERE price BETWEEN 0 AND 100000),
k AS (SELECT order_id, count(*) AS n, CAST(order_id AS BIGINT) % {LATER_ORDER}
  <> 0 AS early FROM s GROUP BY order_id)
SELECT 'r1' AS run_id, 'duplicate_key' AS reject_reasons,
  CAST(sum(n - 1) AS BIGINT) AS rejected FROM k WHERE early
UNION ALL SELECT 'r2', 'duplicate_key', CAST(sum(n - 1) AS BIGINT) FROM k
UNION ALL SELECT 'r2', 'key_in_earlier_run', count(*) FROM k WHERE early""")
def load_key_rejects(spark, sf_dir):
    """Rows rejected for a key of their own run or of an earlier one."""
    return spark.read.parquet(_two_runs(spark, sf_dir) + "_rejects").filter(
        F.col("reject_reasons").isin("duplicate_key",
                                     "key_in_earlier_run")).groupBy(
        "run_id", "reject_reasons").agg(F.count(F.lit(1)).alias("rejected"))


@register("csv_keep_first", f"""
WITH {SQL_RAW}
SELECT * REPLACE (CAST(_row AS VARCHAR) AS _row) FROM raw
QUALIFY row_number() OVER (PARTITION BY order_id
  ORDER BY (_row * {SHUFFLE}) % {WITHIN}, _row, product_id, price,
           shipping_days) = 1""")
def csv_keep_first(spark, sf_dir):
    """U2 on files: of an order's rows the first in the delivered files stays,
    whatever its values."""
    d = scratch_path(spark, "delivered-csv")
    place = [F.pmod(F.col("_row") * SHUFFLE, F.lit(WITHIN)), "_row",
             "product_id", "price", "shipping_days"]
    # more files as the table grows, so that no task sorts a fixed share of it
    files = max(5, input_bytes(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
                // FILE_INPUT + 1)
    export_csv(lens.raw_sales(spark, sf_dir).repartitionByRange(files, *place)
               .sortWithinPartitions(*place), d)
    read = read_directory(spark, d, pattern="part-*.csv", with_order=True)
    return clean.dedupe(read.data, ["order_id"], list(DELIVERED)).drop(
        *DELIVERED)


# Layouts by order key, with the same text as DuckDB writes it; the last is
# no layout of a date.
_LAYOUTS = (("yyyy-MM-dd HH:mm", "%Y-%m-%d %H:%M"),
            ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "%Y-%m-%dT%H:%M:%S.%f"),
            ("yyyy-MM-dd'T'HH:mm:ss'+02:00'", "%Y-%m-%dT%H:%M:%S+02:00"),
            ("yyyy-MM-dd'T'HH:mm:ss'Z'", "%Y-%m-%dT%H:%M:%SZ"),
            ("dd.MM.yyyy", "%d.%m.%Y"), ("yyyyMMdd", "%Y%m%d"),
            ("dd/MM/yyyy", "%d/%m/%Y"), ("'week 'DDD", "week %j"))


def _texts(spark, sf_dir):
    o = lens.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderdate"))
    which, n = F.col("k") % len(_LAYOUTS), len(_LAYOUTS)
    text = F.coalesce(*[F.when(which == i, F.date_format("o_orderdate", f))
                        for i, (f, _) in enumerate(_LAYOUTS)])
    return o.select("k", text.alias("date_text"))


_SQL_TEXTS = "t AS (SELECT o_orderkey AS k, o_orderdate AS d, CASE " + " ".join(
    f"WHEN o_orderkey % {len(_LAYOUTS)} = {i} THEN strftime(o_orderdate, "
    f"'{f}')" for i, (_, f) in enumerate(_LAYOUTS)) + \
    " END AS date_text FROM orders)"


@register("coerce_datetime_layouts", f"""
WITH {_SQL_TEXTS}
SELECT k, date_text, CASE k % {len(_LAYOUTS)}
  WHEN 0 THEN date_trunc('minute', d) WHEN 1 THEN d
  WHEN 2 THEN d - INTERVAL 2 HOUR WHEN 3 THEN d
  WHEN 7 THEN NULL ELSE date_trunc('day', d) END::TIMESTAMP AS seen_at
FROM t""")
def coerce_datetime_layouts(spark, sf_dir):
    """Minutes, fractions, offsets and day-first dates, by the layouts
    found in the column (of day and month whichever way more texts parse)."""
    texts = _texts(spark, sf_dir).withColumn("seen_at", F.col("date_text"))
    layouts = clean.choose_layouts(clean.layout_profile(
        texts, ["seen_at"], ALL_FORMATS))
    return clean.coerce_types(texts, {"seen_at": "datetime"},
                              layouts=layouts)


@register("datetime_layout_profile", f"""
WITH {_SQL_TEXTS},
f(layout, i) AS (VALUES ('yyyy-MM-dd HH:mm', 0),
  ('yyyy-MM-dd''T''HH:mm:ss.SSSSSS', 1), ('yyyy-MM-dd''T''HH:mm:ssXXX', 2),
  ('dd.MM.yyyy', 4), ('yyyyMMdd', 5), ('dd/MM/yyyy', 6), (NULL, 7)),
n AS (SELECT f.layout, count(*) FILTER (WHERE k % {len(_LAYOUTS)} = f.i
  OR f.i = 2 AND k % {len(_LAYOUTS)} = 3) AS parsed FROM t, f GROUP BY ALL)
SELECT 'date_text' AS column_name, layout, parsed FROM n
UNION ALL SELECT 'date_text', 'MM/dd/yyyy', count(*) FROM t
  WHERE k % {len(_LAYOUTS)} = 6 AND day(d) <= 12""")
def datetime_layout_profile(spark, sf_dir):
    """How many texts of a column each layout parses, and how many none
    does."""
    profile = clean.layout_profile(_texts(spark, sf_dir), ["date_text"])
    return profile.filter("parsed > 0 OR layout IS NULL")
