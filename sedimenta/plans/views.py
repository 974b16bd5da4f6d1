"""Reporting views over the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions.columns import date_key, moment
from sedimenta.plans.snapshots import order_count

# Fixed value: days the product view looks back.
PRODUCT_WINDOW_DAYS = 30


def v_customer_360(dim_customer: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Current customers who are active in the latest month of all.

    The month is a scalar subquery, so on a table partitioned by month only that
    partition is read.
    """
    latest = snapshot.filter(F.col("month_key") == snapshot.agg(F.max("month_key")).scalar())
    current = dim_customer.filter(F.col("_is_current")).select(
        "dim_customer_key", "customer_id", "first_name", "last_name", "customer_type", "rfm_segment"
    )
    return current.join(latest, "dim_customer_key").select(
        "customer_id",
        "first_name",
        "last_name",
        "customer_type",
        "rfm_segment",
        F.col("month_key").alias("latest_activity_month"),
        "lifetime_revenue",
        "lifetime_orders",
        "aov_lifetime",
        "recency_days",
    )


def v_monthly_sales_trend(
    fact_orders: DataFrame, dim_date: DataFrame, unique_orders: bool = False
) -> DataFrame:
    """Revenue, orders and average order value by month, latest first."""
    days = dim_date.select("dim_date_key", "year", "month_name", "month_number")
    return (
        fact_orders.select("dim_date_key", "order_number", "total_amount")
        .join(days, "dim_date_key")
        .groupBy("year", "month_name", "month_number")
        .agg(
            F.sum("total_amount").alias("total_revenue"),
            order_count(unique_orders).alias("total_orders"),
            F.avg("total_amount").alias("aov"),
        )
        .orderBy(F.col("year").desc(), F.col("month_number").desc())
    )


def v_product_performance(
    fact_order_lines: DataFrame,
    dim_product: DataFrame,
    dim_date: DataFrame,
    as_of: Column | dt.datetime | str,
) -> DataFrame:
    """Units and revenue by product over the last days before ``as_of``, best first.

    The bound on the day is repeated on the fact's date key (the same day as a
    number): the fact scan can then skip partitions without waiting for the
    date dimension.  Lines are summed per product key before they meet the
    product names, so the join sees one row per product.
    """
    first_day = F.date_sub(moment(as_of).cast("date"), PRODUCT_WINDOW_DAYS)
    days = dim_date.filter(F.col("full_date") >= first_day).select("dim_date_key")
    per_product = (
        fact_order_lines.filter(F.col("dim_date_key") >= date_key(first_day))
        .join(days, "dim_date_key")
        .groupBy("dim_product_key")
        .agg(F.sum("quantity").alias("_units"), F.sum("line_amount").alias("_revenue"))
    )
    products = dim_product.select("dim_product_key", "category_name", "brand_name", "product_name")
    return (
        per_product.join(products, "dim_product_key")
        .groupBy("category_name", "brand_name", "product_name")
        .agg(
            F.sum("_units").alias("units_sold"),
            F.sum("_revenue").cast("decimal(28,2)").alias("revenue_generated"),
        )
        .orderBy(F.col("revenue_generated").desc())
    )


_VIEW_SQL = {
    "v_customer_360": """
        SELECT c.customer_id, c.first_name, c.last_name, c.customer_type, c.rfm_segment,
               s.month_key AS latest_activity_month, s.lifetime_revenue, s.lifetime_orders, s.aov_lifetime,
               s.recency_days
        FROM {db}.agg_customer_monthly_snapshot s JOIN {db}.dim_customer c USING (dim_customer_key)
        WHERE s.month_key = (SELECT max(month_key) FROM {db}.agg_customer_monthly_snapshot) AND c._is_current""",
    "v_monthly_sales_trend": """
        SELECT year, month_name, month_number, sum(total_amount) AS total_revenue,
               count(DISTINCT order_number) AS total_orders, avg(total_amount) AS aov
        FROM {db}.fact_orders JOIN {db}.dim_date USING (dim_date_key)
        GROUP BY year, month_name, month_number ORDER BY year DESC, month_number DESC""",
    "v_product_performance": """
        SELECT category_name, brand_name, product_name, sum(quantity) AS units_sold,
               CAST(sum(line_amount) AS DECIMAL(28,2)) AS revenue_generated
        FROM {db}.fact_order_lines JOIN {db}.dim_product USING (dim_product_key)
        JOIN {db}.dim_date USING (dim_date_key)
        WHERE full_date >= date_sub({day}, {days})
        GROUP BY category_name, brand_name, product_name ORDER BY revenue_generated DESC""",
}


def publish_views(spark: SparkSession, database: str, day: str = "current_date()") -> None:
    """Create the three reports as catalog views over the star's tables in ``database``.

    They outlive the session and read whatever the tables hold when queried;
    ``day`` is the SQL of the day up to which products are reported.
    """
    for name, text in _VIEW_SQL.items():
        body = text.format(db=database, day=day, days=PRODUCT_WINDOW_DAYS)
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {body}")


def register_views(
    tables: dict[str, DataFrame], as_of: Column | dt.datetime | str
) -> dict[str, DataFrame]:
    """Create the three temporary views from the named tables."""
    views = {
        "v_customer_360": v_customer_360(tables["dim_customer"], tables["agg_customer_monthly_snapshot"]),
        "v_monthly_sales_trend": v_monthly_sales_trend(tables["fact_orders"], tables["dim_date"]),
        "v_product_performance": v_product_performance(
            tables["fact_order_lines"], tables["dim_product"], tables["dim_date"], as_of
        ),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return views
