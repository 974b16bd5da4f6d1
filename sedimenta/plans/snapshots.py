"""Customer by month."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sedimenta.functions.columns import conform, moment, month_key, with_audit
from sedimenta.plans.schemas import CUSTOMER_MONTHLY_SNAPSHOT, FACT_ORDERS
from sedimenta.session import stored
from sedimenta.sinks.partitions import partition_value, write_partitions
from sedimenta.sources.tables import read_snapshot
from sedimenta.sources.versions import (
    changed_partitions,
    is_complete,
    manifest_path,
    partition_places,
    read_places,
)


def order_count(unique_orders: bool) -> Column:
    """Distinct orders.  Where each order number is known to occur once, a plain
    count gives the same and spares the shuffle of every order number."""
    return F.count("order_number") if unique_orders else F.count_distinct("order_number")


def customer_monthly_base(
    fact_orders: DataFrame, dim_date: DataFrame, unique_orders: bool = False
) -> DataFrame:
    """Month sums per customer key.  Days unknown to the date dimension are left out.

    Sums are combined before the shuffle, and distinct orders are counted in two
    steps (first spread by order number), so a customer with a third of all
    orders does not fill one task.
    """
    days = dim_date.select("dim_date_key", "full_date")
    return (
        fact_orders.select("dim_date_key", "dim_customer_key", "order_number", "total_amount", "discount_amount")
        .join(days, "dim_date_key")
        .groupBy("dim_customer_key", month_key("full_date").alias("month_key"))
        .agg(
            F.sum("total_amount").cast("decimal(18,2)").alias("monthly_revenue"),
            order_count(unique_orders).cast("int").alias("monthly_orders"),
            F.sum("discount_amount").cast("decimal(18,2)").alias("monthly_discount"),
            F.max("full_date").alias("last_order_date_in_month"),
        )
    )


def customer_monthly_snapshot(
    fact_orders: DataFrame,
    dim_date: DataFrame,
    run_id: str,
    as_of: Column | dt.datetime | str,
    unique_orders: bool = False,
) -> DataFrame:
    """Month sums, running lifetime sums, recency and average order value.

    The window runs over aggregated rows: one per customer and month.
    """
    so_far = (
        Window.partitionBy("dim_customer_key")
        .orderBy("month_key")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = (
        customer_monthly_base(fact_orders, dim_date, unique_orders)
        .withColumns(
            {
                "lifetime_revenue": F.sum("monthly_revenue").over(so_far).cast("decimal(18,2)"),
                "lifetime_orders": F.sum("monthly_orders").over(so_far).cast("int"),
                "recency_days": F.datediff(moment(as_of).cast("date"), F.col("last_order_date_in_month")),
            }
        )
        .withColumn("aov_lifetime", F.try_divide("lifetime_revenue", "lifetime_orders"))
    )
    return conform(with_audit(rows, run_id, {"_created_date": as_of}), CUSTOMER_MONTHLY_SNAPSHOT)


# What a month's row keeps, and what runs on from month to month.
_MONTHLY = ("monthly_revenue", "monthly_orders", "monthly_discount", "last_order_date_in_month")
_LIFETIME = {"lifetime_revenue": "decimal(18,2)", "lifetime_orders": "int"}


def _running(monthly: DataFrame, opening: DataFrame | None) -> DataFrame:
    """Month sums with running sums, which go on from ``opening`` (one row per customer)."""
    so_far = (
        Window.partitionBy("dim_customer_key")
        .orderBy("month_key")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = {name: F.lit(0) for name in _LIFETIME}
    if opening is not None:
        opening = opening.select("dim_customer_key", *[F.col(n).alias(f"_{n}") for n in _LIFETIME])
        monthly = monthly.join(opening, "dim_customer_key", "left")
        before = {name: F.coalesce(f"_{name}", F.lit(0)) for name in _LIFETIME}
    sums = {
        name: (F.sum(name.replace("lifetime", "monthly")).over(so_far) + before[name]).cast(kind).alias(name)
        for name, kind in _LIFETIME.items()
    }
    return monthly.select("dim_customer_key", *_MONTHLY, *sums.values(), "month_key")


def _opening(state: DataFrame, places: Mapping[str, int], first: int) -> DataFrame:
    """Every customer's running sums before the month ``first``.

    They are kept for the month from which the load before went on (in a folder of that
    month's number, negative).  From there on the months in between are read; for an
    earlier ``first`` all months before it.
    """
    kept = [-value for part in places if (value := partition_value(part)) is not None and value < 0]
    since = max((month for month in kept if month <= first), default=None)
    rows = state.filter((F.col("month_key") > 0) & (F.col("month_key") < first))
    if since is not None:
        rows = rows.filter(F.col("month_key") >= since).unionByName(state.filter(F.col("month_key") == -since))
    # A negative number also orders before every month.
    return rows.groupBy("dim_customer_key").agg(*[F.max_by(n, "month_key").alias(n) for n in _LIFETIME])


def maintain_customer_months(
    spark: SparkSession,
    facts_root: str,
    root: str,
    version: int,
    dim_date: DataFrame,
    month_of: Callable[[int], int] = lambda day: day // 100,
    also: Iterable[int] = (),
    unique_orders: bool = False,
    facts_schema: StructType = FACT_ORDERS,
) -> DataFrame:
    """Next version of every customer's month and running sums, from what the order facts changed.

    The facts under ``facts_root`` lie in folders by day or month (``month_of`` gives the month of a
    folder's value), in versions of the same numbers.  Months in which a folder changed since the version
    before, and those of ``also``, are summed again; no other fact is read.  Running sums
    of the first of them and all later months go on from the months before; earlier
    months keep their files.  :func:`snapshot_of_months` makes the snapshot of it.

    Without a version before, all months are summed.  May be repeated.
    """
    if not is_complete(spark, manifest_path(root, version)):
        places = partition_places(spark, facts_root, version)
        if not is_complete(spark, manifest_path(root, version - 1)):
            facts = read_places(spark, facts_root, places, facts_schema)
            write_partitions(_running(customer_monthly_base(facts, dim_date, unique_orders), None), root, version, ["month_key"])
        else:
            changed = changed_partitions(spark, facts_root, version - 1, version)
            months = {month_of(value) for part in changed if (value := partition_value(part)) is not None}
            _maintain(spark, facts_root, root, version, dim_date, months | set(also), month_of, unique_orders, facts_schema)
    return read_snapshot(spark, root, version).filter("month_key > 0")


def _maintain(spark, facts_root, root, version, dim_date, months, month_of, unique_orders, facts_schema) -> None:
    state = read_snapshot(spark, root, version - 1)
    places = partition_places(spark, root, version - 1)
    if not months:
        write_partitions(state.limit(0), root, version, ["month_key"], base=version - 1)
        return
    first = min(months)
    touched = {
        part: at
        for part, at in partition_places(spark, facts_root, version).items()
        if (value := partition_value(part)) is not None and month_of(value) in months
    }
    facts = read_places(spark, facts_root, touched, facts_schema)
    again = customer_monthly_base(facts, dim_date, unique_orders).filter(F.col("month_key").isin(*sorted(months)))
    later = state.filter((F.col("month_key") >= first) & ~F.col("month_key").isin(*sorted(months)))
    columns = ["dim_customer_key", "month_key", *_MONTHLY]
    opening = stored(_opening(state, places, first), "opening")
    rows = _running(again.select(*columns).unionByName(later.select(*columns)), opening)
    kept = opening.select(
        "dim_customer_key",
        *[F.lit(None).cast(rows.schema[n].dataType).alias(n) for n in _MONTHLY],
        *_LIFETIME,
        F.lit(-first).alias("month_key"),
    )
    replaced = [p for p in places if (value := partition_value(p)) is not None and (value >= first or value < 0)]
    write_partitions(rows.unionByName(kept), root, version, ["month_key"], replaced, version - 1)


def snapshot_of_months(months: DataFrame, run_id: str, as_of: Column | dt.datetime | str) -> DataFrame:
    """The customer snapshot as of a time; the rows of :func:`customer_monthly_snapshot`."""
    rows = months.withColumns(
        {
            "recency_days": F.datediff(moment(as_of).cast("date"), F.col("last_order_date_in_month")),
            "aov_lifetime": F.try_divide("lifetime_revenue", "lifetime_orders"),
        }
    )
    return conform(with_audit(rows, run_id, {"_created_date": as_of}), CUSTOMER_MONTHLY_SNAPSHOT)
