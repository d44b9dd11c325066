"""The "sales lens": the driver's TPC-H-style tables seen as the sales
warehouse the library is built for.

``sales``        = lineitem ⋈ orders ⋈ part in the ``sales_transactions`` shape
``dirty_sales``  = the same rows with deterministic dirt (nulls, negative
                   prices, re-sent rows) for the cleaning and quality checks
``raw_sales``    = the dirty rows as every-column-text, the way a CSV
                   extract delivers them (unparseable prices, mixed date
                   layouts, junk dates)
``customers`` / ``products`` / ``order_items`` map to customer / part / lineitem.

Dirt is a pure function of each row's keys, so every run, every engine
and every scale factor injects it the same way over the whole tables.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# The instant every lens query treats as "now": the last order date present
# in the test tables, so recency windows are non-empty at every scale factor.
AS_OF = _dt.datetime(2001, 8, 1)
# An earlier "now" for the future-date check (orders after it are "future").
FUTURE_AS_OF = _dt.datetime(2001, 1, 1)
# Dirt rules on the order key k (l_orderkey / o_orderkey) and part key:
DIRT_NULL_CUSTOMER = 17      # k % 17 = 0 → customer_id missing
DIRT_NULL_PRICE = 19         # k % 19 = 0 → price missing
DIRT_NEGATIVE_PRICE = 23     # k % 23 = 0 → price negated
DIRT_TEXT_PRICE = 7          # k % 7 = 0  → price text 'abc' (raw lens only)
DIRT_JUNK_DATE = 29          # k % 29 = 0 → order_date text 'Unknown' (raw)
DIRT_NULL_CATEGORY = 11      # partkey % 11 = 0 → product_category missing
DIRT_RESENT = 50             # k % 50 = 0 → the row is delivered twice
HIDDEN_CUSTOMER = 20         # custkey % 20 = 0 → absent from the customer master
# ---------------------------------------------------------------------------

SALES_COLUMNS = ("order_id", "line_no", "customer_id", "order_date",
                 "product_id", "product_category", "price", "payment_type",
                 "shipping_days")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Session setting: spread a fact table's rows over so many tasks before the
# joins. A test file of one row group is one scan task; the bench asks for a
# task per core. Unset, the plan is the plain scan.
SPREAD = "loadstar.scan.spread"


def fact_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = table(spark, sf_dir, name)
    spread = int(spark.conf.get(SPREAD, "0"))
    return df.repartition(spread) if spread else df


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Projections first so the parquet scans read only these columns. The
    # join strategy is left to Catalyst/AQE: at test scale part and orders
    # are measured and broadcast; at warehouse scale both joins stay
    # sort-merge joins on their keys (orders and part grow with the data).
    # Part comes first: it adds one column to the rows that the second join
    # shuffles, orders three; and an order's lines end up side by side, which
    # what is written from them compresses well.
    li = fact_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice",
        "l_shipdate")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (li.join(p, F.col("l_partkey") == F.col("p_partkey"))
              .join(o, F.col("l_orderkey") == F.col("o_orderkey")))


def _price() -> Column:
    return F.col("l_extendedprice").cast("decimal(10,2)")


def _shipping_days() -> Column:
    return F.datediff(F.col("l_shipdate"), F.col("o_orderdate"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean sales rows (one per order line)."""
    return _joined(spark, sf_dir).select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("p_type").alias("product_category"),
        _price().alias("price"),
        F.col("o_orderpriority").alias("payment_type"),
        _shipping_days().alias("shipping_days"),
    )


def _k(m: int) -> Column:
    return F.col("l_orderkey") % m == 0


def _dirty_projection(df: DataFrame) -> DataFrame:
    price = (F.when(_k(DIRT_NULL_PRICE), F.lit(None).cast("decimal(10,2)"))
              .when(_k(DIRT_NEGATIVE_PRICE), -_price())
              .otherwise(_price()))
    return df.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.when(~_k(DIRT_NULL_CUSTOMER), F.col("o_custkey").cast("string"))
         .alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.when(F.col("l_partkey") % DIRT_NULL_CATEGORY != 0, F.col("p_type"))
         .alias("product_category"),
        price.cast("decimal(10,2)").alias("price"),
        F.col("o_orderpriority").alias("payment_type"),
        _shipping_days().alias("shipping_days"),
        F.col("l_orderkey").alias("_k"),
    )


def dirty_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed sales rows with nulls, negative prices and re-sent rows."""
    return _resent(_dirty_projection(_joined(spark, sf_dir))).drop(
        "_k", "_copy")


def _resent(d: DataFrame) -> DataFrame:
    """Rows with ``_copy`` = 0, and the re-sent ones once more with 1."""
    return d.withColumn("_copy", F.explode(F.when(
        F.col("_k") % DIRT_RESENT == 0, F.array(F.lit(0), F.lit(1)))
        .otherwise(F.array(F.lit(0)))))


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty rows as text columns, plus a ``_row`` ordinal that stands
    for the position in the delivered file (used by keep-first dedupe)."""
    d = _resent(_dirty_projection(_joined(spark, sf_dir)))
    k = F.col("_k")
    date_text = (F.when(k % DIRT_JUNK_DATE == 0, F.lit("Unknown"))
                  .when(k % 3 == 0, F.date_format("order_date", "MM/dd/yyyy"))
                  .when(k % 3 == 1, F.date_format("order_date",
                                                  "yyyy-MM-dd HH:mm:ss"))
                  .otherwise(F.date_format("order_date", "yyyy-MM-dd")))
    price_text = F.when(k % DIRT_TEXT_PRICE == 0, F.lit("abc")).otherwise(
        F.col("price").cast("string"))
    return d.select(
        F.col("order_id"),
        F.col("line_no").cast("string").alias("line_no"),
        F.col("customer_id"),
        date_text.alias("order_date"),
        F.col("product_id"),
        F.col("product_category"),
        price_text.alias("price"),
        F.col("payment_type"),
        F.col("shipping_days").cast("string").alias("shipping_days"),
        (k * 1000 + F.col("line_no") + F.col("_copy") * 500).alias("_row"),
    )


def customers(spark: SparkSession, sf_dir: str, hide_some: bool = False
              ) -> DataFrame:
    """The customer master in the ``customers`` shape."""
    c = table(spark, sf_dir, "customer")
    if hide_some:
        c = c.filter(F.col("c_custkey") % HIDDEN_CUSTOMER != 0)
    return c.select(F.col("c_custkey").cast("string").alias("customer_id"),
                    F.col("c_name").alias("customer_name"),
                    F.col("c_mktsegment").alias("segment"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("total_price"))


# ---- the same lens as DuckDB SQL, for the oracle ---------------------------

SQL_JOINED = """
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey"""

SQL_SALES = f"""sales AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS order_id,
         l.l_linenumber AS line_no,
         CAST(o.o_custkey AS VARCHAR) AS customer_id,
         o.o_orderdate AS order_date,
         CAST(l.l_partkey AS VARCHAR) AS product_id,
         p.p_type AS product_category,
         CAST(l.l_extendedprice AS DECIMAL(10,2)) AS price,
         o.o_orderpriority AS payment_type,
         CAST(date_diff('day', CAST(o.o_orderdate AS DATE),
                        CAST(l.l_shipdate AS DATE)) AS INTEGER) AS shipping_days
  {SQL_JOINED})"""

SQL_DIRTY_BASE = f"""dirty_base AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS order_id,
         l.l_linenumber AS line_no,
         CASE WHEN l.l_orderkey % {DIRT_NULL_CUSTOMER} <> 0
              THEN CAST(o.o_custkey AS VARCHAR) END AS customer_id,
         o.o_orderdate AS order_date,
         CAST(l.l_partkey AS VARCHAR) AS product_id,
         CASE WHEN l.l_partkey % {DIRT_NULL_CATEGORY} <> 0 THEN p.p_type END
           AS product_category,
         CAST(CASE WHEN l.l_orderkey % {DIRT_NULL_PRICE} = 0 THEN NULL
                   WHEN l.l_orderkey % {DIRT_NEGATIVE_PRICE} = 0
                     THEN -CAST(l.l_extendedprice AS DECIMAL(10,2))
                   ELSE CAST(l.l_extendedprice AS DECIMAL(10,2)) END
              AS DECIMAL(10,2)) AS price,
         o.o_orderpriority AS payment_type,
         CAST(date_diff('day', CAST(o.o_orderdate AS DATE),
                        CAST(l.l_shipdate AS DATE)) AS INTEGER) AS shipping_days,
         l.l_orderkey AS _k
  {SQL_JOINED})"""

SQL_DIRTY = f"""{SQL_DIRTY_BASE},
dirty AS (
  SELECT * EXCLUDE (_k) FROM dirty_base
  UNION ALL
  SELECT * EXCLUDE (_k) FROM dirty_base WHERE _k % {DIRT_RESENT} = 0)"""

SQL_RAW = f"""{SQL_DIRTY_BASE},
dirty2 AS (
  SELECT *, 0 AS _copy FROM dirty_base
  UNION ALL
  SELECT *, 1 AS _copy FROM dirty_base WHERE _k % {DIRT_RESENT} = 0),
raw AS (
  SELECT order_id,
         CAST(line_no AS VARCHAR) AS line_no,
         customer_id,
         CASE WHEN _k % {DIRT_JUNK_DATE} = 0 THEN 'Unknown'
              WHEN _k % 3 = 0 THEN strftime(order_date, '%m/%d/%Y')
              WHEN _k % 3 = 1 THEN strftime(order_date, '%Y-%m-%d %H:%M:%S')
              ELSE strftime(order_date, '%Y-%m-%d') END AS order_date,
         product_id,
         product_category,
         CASE WHEN _k % {DIRT_TEXT_PRICE} = 0 THEN 'abc'
              ELSE CAST(price AS VARCHAR) END AS price,
         payment_type,
         CAST(shipping_days AS VARCHAR) AS shipping_days,
         _k * 1000 + line_no + _copy * 500 AS _row
  FROM dirty2)"""

SQL_CUSTOMERS = """customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
         c_mktsegment AS segment
  FROM customer)"""

SQL_CUSTOMERS_HIDDEN = f"""customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
         c_mktsegment AS segment
  FROM customer WHERE c_custkey % {HIDDEN_CUSTOMER} <> 0)"""

SQL_PRODUCTS = """products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
         p_type AS product_category,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price
  FROM part)"""

SQL_ORDER_ITEMS = """order_items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS line_no,
         CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS total_price
  FROM lineitem)"""
