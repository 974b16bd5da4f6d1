"""Facts of the star schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sedimenta.functions.columns import conform, date_key, with_audit
from sedimenta.operators.history import current_rows
from sedimenta.operators.keys import UNKNOWN_KEY, lookup_key
from sedimenta.operators.merge import upsert
from sedimenta.plans.schemas import FACT_ORDER_LINES, FACT_ORDERS

# Order and line states the facts refer to.
DRAFT = "Draft"
DELIVERED = "Delivered"
CLOSED = "Closed"


def fact_orders(
    orders: DataFrame,
    dim_customer: DataFrame,
    dim_location: DataFrame,
    run_id: str,
    as_of: Column | dt.datetime | str,
) -> DataFrame:
    """One row per order that is no draft.  An order without status is no order yet, so it is left out."""
    placed = orders.filter(F.col("order_status") != DRAFT)
    keyed = lookup_key(placed, current_rows(dim_customer), "customer_id", "customer_id", "dim_customer_key")
    keyed = lookup_key(keyed, dim_location, "shipping_address_id", "address_id", "dim_location_key")
    rows = keyed.withColumns(
        {
            "dim_date_key": date_key("order_date"),
            "dim_campaign_key": F.lit(UNKNOWN_KEY).cast("long"),
            "is_delivered": F.when(F.col("order_status") == DELIVERED, 1).otherwise(0),
        }
    )
    return conform(with_audit(rows, run_id, {"_created_date": as_of}), FACT_ORDERS)


def upsert_orders(target: DataFrame | None, orders: DataFrame) -> DataFrame:
    """Next state of the order fact, by order number."""
    return upsert(target, orders, ["order_number"])


def fact_order_lines(
    lines: DataFrame,
    orders: DataFrame,
    dim_product: DataFrame,
    dim_customer: DataFrame,
    run_id: str,
    as_of: Column | dt.datetime | str,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per line of a known order.

    The customer is looked up on the orders, before they meet the lines: orders
    are the smaller side, so the lines are shuffled for one lookup less.  Columns named by
    ``carry``, of the lines or the orders' ``customer_id``, come along after those of the fact.
    """
    carried = ["customer_id"] if "customer_id" in carry else []
    headers = lookup_key(
        orders.select("order_number", "order_date", "customer_id"),
        current_rows(dim_customer),
        "customer_id",
        "customer_id",
        "dim_customer_key",
    ).select("order_number", date_key("order_date").alias("dim_date_key"), "dim_customer_key", *carried)
    keyed = lookup_key(lines, dim_product, "product_id", "product_id", "dim_product_key")
    rows = keyed.join(headers, "order_number", "inner").withColumns(
        {
            "dim_order_key": F.lit(None).cast("long"),
            "line_status": F.lit(CLOSED),
        }
    )
    further = [rows.schema[name] for name in dict.fromkeys(carry) if name not in FACT_ORDER_LINES.names]
    return conform(with_audit(rows, run_id, {"_created_date": as_of}), StructType([*FACT_ORDER_LINES.fields, *further]))


def undated_lines(old: DataFrame | None, lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Next state of the lines without a day: those of the orders given are replaced, others stay."""
    new = lines.filter(F.col("dim_date_key").isNull())
    if old is None:
        return new
    older = old.filter(F.col("dim_date_key").isNull())
    kept = older.join(orders.select("order_number").distinct(), "order_number", "left_anti")
    return kept.select(*new.columns).unionByName(new)
