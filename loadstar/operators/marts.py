"""Sales marts and export frames.

Each mart is one ``groupBy().agg()``: Spark runs it as a partial (map-side)
aggregate, one shuffle on the grouping key, and a final aggregate, so a hot
day or product is combined inside each task before anything is shuffled.
Money columns are summed exactly as decimals and only then turned into
double; averages are ``sum / count`` so every engine gets the same digits.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import as_datetime, day_of, days_before, month_of


def _revenue(price: str = "price") -> Column:
    return F.sum(price).cast("double")


def _average(price: str = "price") -> Column:
    return F.sum(price).cast("double") / F.count(price)


def daily_sales(sales: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """Per calendar day — distinct orders and customers, revenue,
    average, min and max price.

    The two exact distinct counts make Catalyst expand each row once per
    distinct column (``Expand``) and aggregate (day, value) pairs first;
    those partial aggregates collapse repeats inside each task.
    ``approx_distinct=True`` swaps in HyperLogLog++ sketches (one pass,
    fixed memory per group) for very high-cardinality days."""
    cd = F.approx_count_distinct if approx_distinct else F.count_distinct
    return (sales.groupBy(day_of("order_date").alias("sale_date"))
            .agg(cd("order_id").alias("order_count"),
                 cd("customer_id").alias("unique_customers"),
                 _revenue().alias("total_revenue"),
                 _average().alias("avg_order_value"),
                 F.min("price").cast("double").alias("min_price"),
                 F.max("price").cast("double").alias("max_price")))


def monthly_sales(sales: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """Per month (first day of the month as a date)."""
    cd = F.approx_count_distinct if approx_distinct else F.count_distinct
    return (sales.groupBy(month_of("order_date").alias("month"))
            .agg(cd("order_id").alias("order_count"),
                 cd("customer_id").alias("unique_customers"),
                 _revenue().alias("total_revenue"),
                 _average().alias("avg_order_value")))


def product_performance(sales: DataFrame, approx_distinct: bool = False
                        ) -> DataFrame:
    """Per (product, category) — line count, revenue, average price,
    distinct customers."""
    cd = F.approx_count_distinct if approx_distinct else F.count_distinct
    return (sales.groupBy("product_id", "product_category")
            .agg(F.count(F.lit(1)).alias("order_count"),
                 _revenue().alias("total_revenue"),
                 _average().alias("avg_price"),
                 cd("customer_id").alias("unique_customers")))


def recent(sales: DataFrame, as_of, days: int,
           date_col: str = "order_date") -> DataFrame:
    """Rows with ``order_date >= as_of date - days`` (midnight bound).
    A plain comparison on the column, so it reaches the parquet scan as a
    pushed filter; when the table is partitioned by the month of the date
    (``order_date_month``, see ``JobSpec.month_partition``) the matching
    month predicate is added too, so older months are never listed or
    read."""
    cond = F.col(date_col) >= days_before(as_of, days)
    month_col = f"{date_col}_month"
    if month_col in sales.columns:
        first = (as_datetime(as_of).date() - _dt.timedelta(days=days)
                 ).replace(day=1)
        cond = cond & (F.col(month_col) >= F.lit(first))
    return sales.filter(cond)


def category_revenue(sales: DataFrame, as_of, days: int = 30) -> DataFrame:
    """A6 + O1: recent revenue by category, largest first (ties by name)."""
    return (recent(sales, as_of, days)
            .groupBy("product_category")
            .agg(F.count(F.lit(1)).alias("order_count"),
                 _revenue().alias("total_revenue"))
            .orderBy(F.desc("total_revenue"), F.asc("product_category")))


def export_detail(sales: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Every column of the recent rows (the frame that is exported)."""
    return recent(sales, as_of, days)


def daily_category(sales: DataFrame, as_of, days: int = 90) -> DataFrame:
    """Recent (day, category) counts and revenue."""
    return (recent(sales, as_of, days)
            .groupBy(day_of("order_date").alias("date"), "product_category")
            .agg(F.count(F.lit(1)).alias("order_count"),
                 _revenue().alias("revenue")))


# --- fixed values -----------------------------------------------------------
VIEW_NAMES = {"daily": "v_daily_sales", "monthly": "v_monthly_sales",
              "product": "v_product_performance"}
# ---------------------------------------------------------------------------


def register_views(sales: DataFrame, approx_distinct: bool = False) -> dict:
    """The three marts as session views, so SQL users can
    ``SELECT * FROM v_daily_sales``; views stay lazy (nothing runs until
    queried)."""
    frames = {"daily": daily_sales(sales, approx_distinct),
              "monthly": monthly_sales(sales, approx_distinct),
              "product": product_performance(sales, approx_distinct)}
    for k, df in frames.items():
        df.createOrReplaceTempView(VIEW_NAMES[k])
    return {VIEW_NAMES[k]: df for k, df in frames.items()}
