"""Cleaning queries over the dirty and raw lenses (S1-style input, P1-P8,
P15-P19, U1-U3, A11-A14, A17, F1-F7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rules import positive_rule, range_rule, required_rule
from ..functions.values import NUMBER_PATTERN
from ..operators import clean, quality
from . import lens
from .jobspec import SALES_JOB
from .lens import SQL_DIRTY, SQL_RAW, SQL_SALES
from .registry import register

SQL_NUM = (f"CASE WHEN regexp_matches({{c}}, '{NUMBER_PATTERN}') "
           "THEN TRY_CAST(trim({c}) AS DOUBLE) END")
SQL_DT = ("coalesce(try_strptime({c}, '%Y-%m-%d %H:%M:%S'), "
          "try_strptime({c}, '%Y-%m-%dT%H:%M:%S'), "
          "try_strptime({c}, '%Y-%m-%d'), "
          "try_strptime({c}, '%m/%d/%Y %H:%M:%S'), "
          "try_strptime({c}, '%m/%d/%Y'))")
RAW_COLS = ("order_id", "line_no", "customer_id", "order_date", "product_id",
            "product_category", "price", "payment_type", "shipping_days")


def num(c: str) -> str:
    return SQL_NUM.format(c=c)


def dt(c: str) -> str:
    return SQL_DT.format(c=c)


@register("dedupe_full_row", f"""
WITH {SQL_DIRTY}
SELECT DISTINCT * FROM dirty""")
def dedupe_full_row(spark, sf_dir):
    return clean.dedupe(lens.dirty_sales(spark, sf_dir))


# The fixture ordinal ``_row`` repeats where the source repeats an order line;
# ties go to the smallest remaining values in column order, nulls first.
@register("dedupe_keep_first", f"""
WITH {SQL_RAW}
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY _row,
    line_no NULLS FIRST, customer_id NULLS FIRST, order_date NULLS FIRST,
    product_id NULLS FIRST, product_category NULLS FIRST, price NULLS FIRST,
    payment_type NULLS FIRST, shipping_days NULLS FIRST) AS rn
  FROM raw) WHERE rn = 1""")
def dedupe_keep_first(spark, sf_dir):
    return clean.dedupe(lens.raw_sales(spark, sf_dir), subset=["order_id"],
                        order_by=["_row"])


@register("concat_by_name", f"""
WITH {SQL_SALES}
SELECT order_id, line_no, price, customer_id FROM sales WHERE line_no <= 3
UNION ALL BY NAME
SELECT order_id, line_no, price, product_id FROM sales WHERE line_no > 3""")
def concat_by_name(spark, sf_dir):
    s = lens.sales(spark, sf_dir)
    a = s.filter(F.col("line_no") <= 3).select("order_id", "line_no", "price",
                                                "customer_id")
    b = s.filter(F.col("line_no") > 3).select("order_id", "line_no", "price",
                                               "product_id")
    return a.unionByName(b, allowMissingColumns=True)


def _class_sql(c: str) -> str:
    tokens = "'True', 'TRUE', 'true', 'False', 'FALSE', 'false'"
    return f"""SELECT '{c}' AS column_name,
  CASE WHEN count(*) = 0 THEN 'text'
       WHEN coalesce(bool_and({c} IS NULL OR regexp_matches({c}, '{NUMBER_PATTERN}')), true) THEN 'numeric'
       WHEN bool_and({c} IS NULL OR {c} IN ({tokens})) AND count({c}) = count(*)
            AND count({c}) > 0 THEN 'boolean'
       ELSE 'text' END AS column_class,
  count(*) - count({c}) AS null_count
FROM raw"""


@register("infer_column_class", f"""
WITH {SQL_RAW}
{" UNION ALL ".join(_class_sql(c) for c in RAW_COLS)}
UNION ALL SELECT '_row', 'numeric', count(*) - count(_row) FROM raw""")
def infer_column_class(spark, sf_dir):
    return clean.column_profile(lens.raw_sales(spark, sf_dir))


# the median of decimals is the mean of the two middle ones, rounded half up
SQL_MEDIAN_PRICE = """q AS (
  SELECT CAST(median(CAST(price * 100 AS BIGINT)) * 2 AS BIGINT) AS c2
  FROM dirty WHERE price IS NOT NULL),
m AS (
  SELECT CAST(CAST(sign(c2) * ((abs(c2) + 1) // 2) AS DECIMAL(18,0)) * 0.01
              AS DECIMAL(10,2)) AS med
  FROM q)"""


@register("fill_median_unknown", f"""
WITH {SQL_DIRTY},
{SQL_MEDIAN_PRICE}
SELECT order_id, line_no, customer_id, order_date, product_id,
       coalesce(product_category, 'Unknown') AS product_category,
       coalesce(price, (SELECT med FROM m)) AS price,
       payment_type, shipping_days
FROM dirty""")
def fill_median_unknown(spark, sf_dir):
    out, _ = clean.fill_missing(lens.dirty_sales(spark, sf_dir),
                                exclude=SALES_JOB.fill_exclude, stage=True)
    return out


@register("coerce_numeric", f"""
WITH {SQL_RAW}
SELECT _row, price AS price_text, {num('price')} AS price FROM raw""")
def coerce_numeric(spark, sf_dir):
    r = lens.raw_sales(spark, sf_dir)
    return clean.coerce_types(
        r.select("_row", F.col("price").alias("price_text"), "price"),
        {"price": "numeric"})


@register("coerce_datetime", f"""
WITH {SQL_RAW}
SELECT _row, order_date AS date_text, {dt('order_date')} AS order_date
FROM raw""")
def coerce_datetime(spark, sf_dir):
    r = lens.raw_sales(spark, sf_dir)
    return clean.coerce_types(
        r.select("_row", F.col("order_date").alias("date_text"),
                 "order_date"), {"order_date": "datetime"})


@register("cast_string", f"""
WITH {SQL_DIRTY}
SELECT order_id, line_no, CAST(price AS VARCHAR) AS price,
       CAST(shipping_days AS VARCHAR) AS shipping_days,
       CAST(order_date AS VARCHAR) AS order_date,
       customer_id
FROM dirty""")
def cast_string(spark, sf_dir):
    d = lens.dirty_sales(spark, sf_dir).select(
        "order_id", "line_no", "price", "shipping_days", "order_date",
        "customer_id")
    return clean.coerce_types(d, {"price": "string", "shipping_days": "string",
                                  "order_date": "string",
                                  "customer_id": "string"})


@register("range_filter", f"""
WITH {SQL_DIRTY}
SELECT * FROM dirty WHERE price BETWEEN 0 AND 100000""")
def range_filter(spark, sf_dir):
    return clean.range_filter(lens.dirty_sales(spark, sf_dir),
                              {"price": (0, 100000)})


@register("range_filter_counts", f"""
WITH {SQL_DIRTY},
f AS (SELECT coalesce(price BETWEEN 0 AND 100000, false) AS p1,
             coalesce(shipping_days BETWEEN 0 AND 365, false) AS p2
      FROM dirty)
SELECT count(*) AS rows_in,
       count(*) FILTER (WHERE NOT p1) AS removed_price,
       count(*) FILTER (WHERE p1 AND NOT p2) AS removed_shipping_days,
       count(*) FILTER (WHERE NOT (p1 AND p2)) AS removed_total,
       count(*) FILTER (WHERE p1 AND p2) AS rows_out
FROM f""")
def range_filter_counts(spark, sf_dir):
    return clean.range_failures(lens.dirty_sales(spark, sf_dir),
                                {"price": (0, 100000),
                                 "shipping_days": (0, 365)})


@register("required_and_positive", f"""
WITH {SQL_DIRTY}
SELECT order_id, line_no, customer_id, order_date, product_id,
       coalesce(product_category, 'Unknown') AS product_category,
       price, payment_type, shipping_days
FROM dirty
WHERE order_id IS NOT NULL AND price IS NOT NULL AND price > 0""")
def required_and_positive(spark, sf_dir):
    d = lens.dirty_sales(spark, sf_dir)
    d = d.na.drop(subset=["order_id", "price"])
    d = d.filter(positive_rule("price").passes())
    return d.na.fill({"product_category": "Unknown"})


def _split_rules():
    return [required_rule(["order_id", "customer_id", "order_date",
                           "product_id", "price"], "required"),
            range_rule("price", 0, 100000, "price_range"),
            range_rule("shipping_days", 0, 365, "shipping_days_range")]


SQL_REASONS = """concat_ws(',',
  CASE WHEN NOT coalesce(order_id IS NOT NULL AND customer_id IS NOT NULL
       AND order_date IS NOT NULL AND product_id IS NOT NULL
       AND price IS NOT NULL, false) THEN 'required' END,
  CASE WHEN NOT coalesce(price BETWEEN 0 AND 100000, false)
       THEN 'price_range' END,
  CASE WHEN NOT coalesce(shipping_days BETWEEN 0 AND 365, false)
       THEN 'shipping_days_range' END)"""


@register("split_good", f"""
WITH {SQL_DIRTY}
SELECT * FROM dirty WHERE {SQL_REASONS} = ''""")
def split_good(spark, sf_dir):
    good, _ = quality.split(lens.dirty_sales(spark, sf_dir), _split_rules())
    return good


@register("split_bad", f"""
WITH {SQL_DIRTY}
SELECT *, {SQL_REASONS} AS reject_reasons FROM dirty
WHERE {SQL_REASONS} <> ''""")
def split_bad(spark, sf_dir):
    _, bad = quality.split(lens.dirty_sales(spark, sf_dir), _split_rules())
    return bad


@register("transform_full", f"""
WITH {SQL_RAW},
d AS (
  SELECT {", ".join(RAW_COLS)}, min(_row) AS _row FROM raw
  GROUP BY ALL),
f AS (
  SELECT order_id, line_no, customer_id, {dt('order_date')} AS order_date,
         product_id, coalesce(product_category, 'Unknown') AS product_category,
         {num("coalesce(price, 'Unknown')")} AS price,
         payment_type, shipping_days
  FROM d)
SELECT * FROM f WHERE price BETWEEN 0 AND 100000""")
def transform_full(spark, sf_dir):
    from .loadjob import transform
    res = transform(lens.raw_sales(spark, sf_dir), SALES_JOB,
                    order_by=["_row"])
    return res.good


@register("schema_check_issues", f"""
WITH {SQL_RAW}
SELECT 'MISSING_COLUMN' AS issue_kind, 'discount' AS column_name,
       'ERROR' AS severity, count(*) AS affected_rows FROM raw
UNION ALL SELECT 'EXTRA_COLUMN', 'line_no', 'WARNING', count(line_no) FROM raw
UNION ALL SELECT 'EXTRA_COLUMN', 'product_category', 'WARNING',
                 count(product_category) FROM raw
UNION ALL SELECT 'EXTRA_COLUMN', 'payment_type', 'WARNING', count(payment_type)
                 FROM raw
UNION ALL SELECT 'EXTRA_COLUMN', 'shipping_days', 'WARNING',
                 count(shipping_days) FROM raw
UNION ALL SELECT 'EXTRA_COLUMN', '_row', 'WARNING', count(_row) FROM raw""")
def schema_check_issues(spark, sf_dir):
    expected = list(SALES_JOB.expected_columns) + ["discount"]
    return clean.schema_issues(lens.raw_sales(spark, sf_dir), expected)
