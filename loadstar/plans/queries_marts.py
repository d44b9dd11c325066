"""Mart and export queries over the sales lens."""

from __future__ import annotations

from ..operators import marts
from . import lens
from .lens import AS_OF, SQL_SALES
from .registry import register


def _since(days: int) -> str:
    import datetime as dt
    d = AS_OF.date() - dt.timedelta(days=days)
    return f"TIMESTAMP '{d.isoformat()} 00:00:00'"


@register("daily_sales", f"""
WITH {SQL_SALES}
SELECT CAST(order_date AS DATE) AS sale_date,
       COUNT(DISTINCT order_id) AS order_count,
       COUNT(DISTINCT customer_id) AS unique_customers,
       CAST(SUM(price) AS DOUBLE) AS total_revenue,
       CAST(SUM(price) AS DOUBLE) / COUNT(price) AS avg_order_value,
       CAST(MIN(price) AS DOUBLE) AS min_price,
       CAST(MAX(price) AS DOUBLE) AS max_price
FROM sales GROUP BY CAST(order_date AS DATE)""")
def daily_sales(spark, sf_dir):
    return marts.daily_sales(lens.sales(spark, sf_dir))


@register("monthly_sales", f"""
WITH {SQL_SALES}
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month,
       COUNT(DISTINCT order_id) AS order_count,
       COUNT(DISTINCT customer_id) AS unique_customers,
       CAST(SUM(price) AS DOUBLE) AS total_revenue,
       CAST(SUM(price) AS DOUBLE) / COUNT(price) AS avg_order_value
FROM sales GROUP BY 1""")
def monthly_sales(spark, sf_dir):
    return marts.monthly_sales(lens.sales(spark, sf_dir))


@register("product_performance", f"""
WITH {SQL_SALES}
SELECT product_id, product_category,
       COUNT(*) AS order_count,
       CAST(SUM(price) AS DOUBLE) AS total_revenue,
       CAST(SUM(price) AS DOUBLE) / COUNT(price) AS avg_price,
       COUNT(DISTINCT customer_id) AS unique_customers
FROM sales GROUP BY product_id, product_category""")
def product_performance(spark, sf_dir):
    return marts.product_performance(lens.sales(spark, sf_dir))


@register("category_revenue_30d", f"""
WITH {SQL_SALES}
SELECT product_category, COUNT(*) AS order_count,
       CAST(SUM(price) AS DOUBLE) AS total_revenue
FROM sales WHERE order_date >= {_since(30)}
GROUP BY product_category
ORDER BY total_revenue DESC, product_category""")
def category_revenue_30d(spark, sf_dir):
    return marts.category_revenue(lens.sales(spark, sf_dir), AS_OF, 30)


@register("export_detail_30d", f"""
WITH {SQL_SALES}
SELECT * FROM sales WHERE order_date >= {_since(30)}""")
def export_detail_30d(spark, sf_dir):
    return marts.export_detail(lens.sales(spark, sf_dir), AS_OF, 30)


@register("export_daily_category_90d", f"""
WITH {SQL_SALES}
SELECT CAST(order_date AS DATE) AS date, product_category,
       COUNT(*) AS order_count, CAST(SUM(price) AS DOUBLE) AS revenue
FROM sales WHERE order_date >= {_since(90)}
GROUP BY 1, 2""")
def export_daily_category_90d(spark, sf_dir):
    return marts.daily_category(lens.sales(spark, sf_dir), AS_OF, 90)
