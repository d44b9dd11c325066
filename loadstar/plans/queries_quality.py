"""Quality-check, referential and validator queries (A1-A5, A15-A19,
J1-J4, M3, S14, X1, P10-P14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rules import required_rule
from ..operators import clean, quality
from . import lens
from .lens import (FUTURE_AS_OF, AS_OF, SQL_CUSTOMERS_HIDDEN, SQL_DIRTY,
                   SQL_ORDER_ITEMS, SQL_PRODUCTS, SQL_SALES)
from .registry import register

FUTURE_TS = f"TIMESTAMP '{FUTURE_AS_OF:%Y-%m-%d %H:%M:%S}'"
AS_OF_TS = f"TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}'"
DIRTY_COLS = ("order_id", "line_no", "customer_id", "order_date", "product_id",
              "product_category", "price", "payment_type", "shipping_days")
# Products whose key is divisible by this are missing from the product master
# in the foreign-key check.
HIDDEN_PRODUCT = 25


@register("dq_duplicates", f"""
WITH {SQL_DIRTY}
SELECT 'Duplicate Records Check' AS check_name,
       COUNT(*) - COUNT(DISTINCT order_id) AS duplicate_count
FROM dirty""")
def dq_duplicates(spark, sf_dir):
    return quality.duplicate_count(lens.dirty_sales(spark, sf_dir))


@register("dq_nulls", f"""
WITH {SQL_DIRTY}
SELECT 'Null Values Check' AS check_name,
  CAST(SUM(CASE WHEN order_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_order_ids,
  CAST(SUM(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_customer_ids,
  CAST(SUM(CASE WHEN price IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_prices
FROM dirty""")
def dq_nulls(spark, sf_dir):
    return quality.null_counts(lens.dirty_sales(spark, sf_dir))


@register("dq_null_profile", f"""
WITH {SQL_DIRTY}
{" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM dirty" for c in DIRTY_COLS)}""")
def dq_null_profile(spark, sf_dir):
    return quality.null_profile(lens.dirty_sales(spark, sf_dir))


@register("dq_invalid_price", f"""
WITH {SQL_DIRTY}
SELECT 'Invalid Price Check' AS check_name, COUNT(*) AS invalid_price_count
FROM dirty WHERE price <= 0 OR price IS NULL""")
def dq_invalid_price(spark, sf_dir):
    return quality.invalid_price_count(lens.dirty_sales(spark, sf_dir))


@register("dq_future_dates", f"""
WITH {SQL_SALES}
SELECT 'Future Date Check' AS check_name, COUNT(*) AS future_date_count
FROM sales WHERE order_date > {FUTURE_TS}""")
def dq_future_dates(spark, sf_dir):
    return quality.future_date_count(lens.sales(spark, sf_dir), FUTURE_AS_OF)


@register("dq_orphan_customers", f"""
WITH {SQL_DIRTY}, {SQL_CUSTOMERS_HIDDEN}
SELECT 'Orphaned Customer Records' AS check_name,
       COUNT(*) AS orphaned_records
FROM dirty st
WHERE NOT EXISTS (SELECT 1 FROM customers c
                  WHERE st.customer_id = c.customer_id)""")
def dq_orphan_customers(spark, sf_dir):
    return quality.orphan_count(lens.dirty_sales(spark, sf_dir),
                                lens.customers(spark, sf_dir, hide_some=True),
                                ["customer_id"])


@register("dq_fk_order_items_orders", f"""
WITH {SQL_DIRTY}, {SQL_ORDER_ITEMS},
loaded AS (SELECT order_id FROM dirty WHERE price BETWEEN 0 AND 100000)
SELECT 'order_items.order_id' AS check_name, COUNT(*) AS orphaned_records
FROM order_items oi
WHERE NOT EXISTS (SELECT 1 FROM loaded s WHERE s.order_id = oi.order_id)""")
def dq_fk_order_items_orders(spark, sf_dir):
    loaded = clean.range_filter(lens.dirty_sales(spark, sf_dir),
                                {"price": (0, 100000)})
    return quality.orphan_count(lens.order_items(spark, sf_dir), loaded,
                                ["order_id"], name="order_items.order_id")


@register("dq_fk_order_items_products", f"""
WITH {SQL_ORDER_ITEMS}, {SQL_PRODUCTS},
listed AS (SELECT product_id FROM products
           WHERE CAST(product_id AS BIGINT) % {HIDDEN_PRODUCT} <> 0)
SELECT 'order_items.product_id' AS check_name, COUNT(*) AS orphaned_records
FROM order_items oi
WHERE NOT EXISTS (SELECT 1 FROM listed p WHERE p.product_id = oi.product_id)""")
def dq_fk_order_items_products(spark, sf_dir):
    listed = lens.products(spark, sf_dir).filter(
        F.col("product_id").cast("bigint") % HIDDEN_PRODUCT != 0)
    return quality.orphan_count(lens.order_items(spark, sf_dir), listed,
                                ["product_id"], name="order_items.product_id")


@register("dq_fk_violations_rows", f"""
WITH {SQL_ORDER_ITEMS}, {SQL_PRODUCTS},
listed AS (SELECT product_id FROM products
           WHERE CAST(product_id AS BIGINT) % {HIDDEN_PRODUCT} <> 0)
SELECT * FROM order_items oi
WHERE NOT EXISTS (SELECT 1 FROM listed p WHERE p.product_id = oi.product_id)""")
def dq_fk_violations_rows(spark, sf_dir):
    listed = lens.products(spark, sf_dir).filter(
        F.col("product_id").cast("bigint") % HIDDEN_PRODUCT != 0)
    return quality.referential_violations(lens.order_items(spark, sf_dir),
                                          listed, ["product_id"])


@register("dq_duplicate_keys", f"""
WITH {SQL_DIRTY}
SELECT order_id, COUNT(*) AS row_count FROM dirty
GROUP BY order_id HAVING COUNT(*) > 1""")
def dq_duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(lens.dirty_sales(spark, sf_dir))


@register("dq_report", f"""
WITH {SQL_DIRTY}, {SQL_CUSTOMERS_HIDDEN},
r AS (
  SELECT 'duplicate_records' AS check_name,
         COUNT(*) - COUNT(DISTINCT order_id) AS affected_rows FROM dirty
  UNION ALL SELECT 'null_order_ids', COUNT(*) FILTER (WHERE order_id IS NULL) FROM dirty
  UNION ALL SELECT 'null_customer_ids', COUNT(*) FILTER (WHERE customer_id IS NULL) FROM dirty
  UNION ALL SELECT 'null_prices', COUNT(*) FILTER (WHERE price IS NULL) FROM dirty
  UNION ALL SELECT 'invalid_prices', COUNT(*) FILTER (WHERE price <= 0 OR price IS NULL) FROM dirty
  UNION ALL SELECT 'future_dates', COUNT(*) FILTER (WHERE order_date > {FUTURE_TS}) FROM dirty
  UNION ALL SELECT 'orphaned_customers', COUNT(*) FROM dirty st
    WHERE NOT EXISTS (SELECT 1 FROM customers c WHERE st.customer_id = c.customer_id))
SELECT check_name, affected_rows,
       CASE WHEN affected_rows > 100 THEN 'CRITICAL' ELSE 'WARNING' END AS severity
FROM r""")
def dq_report(spark, sf_dir):
    return quality.quality_report(lens.dirty_sales(spark, sf_dir),
                                  lens.customers(spark, sf_dir, hide_some=True),
                                  FUTURE_AS_OF)


@register("dq_log_rows", f"""
WITH {SQL_DIRTY}
SELECT 'sales_transactions' AS table_name, 'Null Values' AS check_type,
       'Missing customer_id values found' AS issue_description,
       COUNT(*) AS affected_rows,
       CASE WHEN COUNT(*) > 100 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
       {AS_OF_TS} AS checked_at
FROM dirty WHERE customer_id IS NULL""")
def dq_log_rows(spark, sf_dir):
    return quality.null_customer_log_row(lens.dirty_sales(spark, sf_dir), AS_OF)


def _validator_sql(src: str) -> str:
    return f"""
v AS (SELECT
  EXISTS (SELECT 1 FROM {src} WHERE order_id IS NULL OR customer_id IS NULL
          OR price IS NULL) AS r,
  EXISTS (SELECT 1 FROM {src} WHERE price < 0 OR price > 1000000) AS p,
  EXISTS (SELECT order_id FROM {src} GROUP BY order_id HAVING COUNT(*) > 1) AS d)
SELECT NOT (r OR p OR d) AS validation_passed,
       CASE WHEN r THEN 'Missing required fields found'
            WHEN p THEN 'Invalid price range detected'
            WHEN d THEN 'Duplicate orders found'
            ELSE 'All validations passed' END AS error_message
FROM v"""


@register("validate_required", f"WITH {SQL_DIRTY}, {_validator_sql('dirty')}")
def validate_required(spark, sf_dir):
    return quality.validate_first_failure(lens.dirty_sales(spark, sf_dir))


@register("validate_price_range", f"""WITH {SQL_DIRTY},
complete AS (SELECT * FROM dirty WHERE order_id IS NOT NULL
             AND customer_id IS NOT NULL AND price IS NOT NULL),
{_validator_sql('complete')}""")
def validate_price_range(spark, sf_dir):
    d = lens.dirty_sales(spark, sf_dir)
    complete = d.filter(required_rule(["order_id", "customer_id",
                                       "price"]).passes())
    return quality.validate_first_failure(complete)


@register("validate_duplicates", f"WITH {SQL_SALES}, {_validator_sql('sales')}")
def validate_duplicates(spark, sf_dir):
    return quality.validate_first_failure(lens.sales(spark, sf_dir))


@register("validate_passed", f"""WITH {SQL_SALES},
firsts AS (SELECT * FROM sales QUALIFY row_number() OVER
           (PARTITION BY order_id ORDER BY line_no) = 1),
{_validator_sql('firsts')}""")
def validate_passed(spark, sf_dir):
    s = clean.dedupe(lens.sales(spark, sf_dir), subset=["order_id"],
                     order_by=["line_no"])
    return quality.validate_first_failure(s)


_TABLE_RULE_SQL = [
    ("order_id_not_null", "order_id IS NULL"),
    ("customer_id_not_null", "customer_id IS NULL"),
    ("order_date_not_null", "order_date IS NULL"),
    ("product_id_not_null", "product_id IS NULL"),
    ("price_not_null", "price IS NULL"),
    ("order_id_max_50", "length(order_id) > 50"),
    ("customer_id_max_50", "length(customer_id) > 50"),
    ("product_id_max_50", "length(product_id) > 50"),
    ("product_category_max_100", "length(product_category) > 100"),
    ("price_fits_decimal(10,2)", "abs(price) >= 100000000"),
    ("payment_type_max_50", "length(payment_type) > 50"),
]


@register("table_rule_failures", f"""
WITH {SQL_DIRTY}
{" UNION ALL ".join(f"SELECT '{n}' AS rule_name, count(*) FILTER (WHERE coalesce({c}, false)) AS failed_rows FROM dirty" for n, c in _TABLE_RULE_SQL)}""")
def table_rule_failures(spark, sf_dir):
    """The sales table's NOT NULL / VARCHAR / NUMERIC constraints as
    rules, counted on the conformed dirty rows."""
    from .. import schemas
    t = schemas.conform(lens.dirty_sales(spark, sf_dir), "sales_transactions",
                        AS_OF)
    return schemas.rule_failures(t, schemas.table_rules("sales_transactions"))


@register("conform_sales_table", f"""
WITH {SQL_DIRTY}
SELECT order_id, customer_id, order_date, product_id, product_category,
       price, payment_type, shipping_days,
       {AS_OF_TS} AS created_at, {AS_OF_TS} AS updated_at
FROM dirty""")
def conform_sales_table(spark, sf_dir):
    """Dirty rows shaped to the sales table with write-time defaults."""
    from .. import schemas
    return schemas.conform(lens.dirty_sales(spark, sf_dir),
                           "sales_transactions", AS_OF)


@register("dq_log_all_checks", f"""
WITH {SQL_DIRTY},
c AS (
  SELECT 'Duplicates' AS check_type, 'Duplicate order ids found' AS issue_description,
         COUNT(*) - COUNT(DISTINCT order_id) AS affected_rows FROM dirty
  UNION ALL SELECT 'Null Values', 'Missing order_id values found',
         COUNT(*) FILTER (WHERE order_id IS NULL) FROM dirty
  UNION ALL SELECT 'Null Values', 'Missing customer_id values found',
         COUNT(*) FILTER (WHERE customer_id IS NULL) FROM dirty
  UNION ALL SELECT 'Null Values', 'Missing price values found',
         COUNT(*) FILTER (WHERE price IS NULL) FROM dirty
  UNION ALL SELECT 'Invalid Values', 'Prices not above zero or missing',
         COUNT(*) FILTER (WHERE price <= 0 OR price IS NULL) FROM dirty
  UNION ALL SELECT 'Future Dates', 'Order dates after the run''s as_of',
         COUNT(*) FILTER (WHERE order_date > {FUTURE_TS}) FROM dirty)
SELECT 'sales_transactions' AS table_name, check_type, issue_description,
       affected_rows,
       CASE WHEN affected_rows > 100 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
       {FUTURE_TS} AS checked_at
FROM c""")
def dq_log_all_checks(spark, sf_dir):
    """S14 for a whole load: every row check as a quality-log row."""
    return quality.quality_log_rows(lens.dirty_sales(spark, sf_dir),
                                    FUTURE_AS_OF)
