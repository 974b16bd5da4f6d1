"""One build of the whole star schema: dimensions, then facts, then the snapshot."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions.columns import date_key, month_key
from sedimenta.operators.merge import replace_where
from sedimenta.plans import dimensions, facts, snapshots
from sedimenta.plans.late_keys import (
    Reference,
    facts_of,
    next_open_references,
    open_references,
    rekeyed,
    resolved_references,
    still_open,
)
from sedimenta.plans.schemas import PARTITIONED_BY, STAR_SCHEMA
from sedimenta.session import stored
from sedimenta.sinks.partitions import replace_version, upsert_version
from sedimenta.sinks.tables import create_database, publish, register_version, write_snapshot
from sedimenta.sources.tables import dates_between, read_snapshot, snapshot_path
from sedimenta.sources.versions import is_complete, manifest_path, partition_names


# Keys of the facts that may have to wait for their dimension row.
ORDER_REFERENCES = (
    Reference("dim_customer_key", "customer_id", "customer_id"),
    Reference("dim_location_key", "shipping_address_id", "address_id"),
)
LINE_REFERENCES = (
    Reference("dim_product_key", "product_id", "product_id"),
    Reference("dim_customer_key", "customer_id", "customer_id"),
)


def read_star(spark: SparkSession, root: str, name: str, version: int) -> DataFrame:
    """A stored table in its declared column order and types."""
    schema = STAR_SCHEMA[name]
    return read_snapshot(spark, f"{root}/{name}", version, schema).select(*schema.names)


def run_star(
    silver: Mapping[str, DataFrame],
    root: str,
    version: int,
    run_id: str,
    as_of: Column | dt.datetime | str,
    first_day: str | None = None,
    last_day: str | None = None,
    lines_from: int | None = None,
    database: str | None = None,
    partition_by: Mapping[str, tuple[str, ...]] = PARTITIONED_BY,
    cluster_by: Mapping[str, tuple[str, ...]] | None = None,
) -> dict[str, DataFrame]:
    """Build version ``version`` of every table on top of the version before.

    ``silver`` holds customers, products, brands, categories, addresses,
    city_tiers, orders and order_lines.  Each table is written before the next
    one reads it, so nothing is computed twice.

    The date dimension spans the days of the orders and of the build before, or
    the days given.  Lines from ``lines_from`` on are replaced; by default from the
    first day of the orders given.  Orders without a date, and their lines, are kept
    in a partition without value.  Every dimension has its unknown member.

    Of facts in folders by one column a build writes only the partitions its orders
    enter or leave, and those of the lines it replaces; a manifest names the others,
    which keep their files.  Of order facts by day the snapshot reads only months that changed.
    With a ``database`` the facts are published there.  Facts with an unknown key are listed under
    ``open_...``; a later build that has their dimension row gives them its key.

    A build that failed is run again with the same version: tables it had completed
    are taken as they are.
    """
    spark = silver["orders"].sparkSession
    cluster_by = cluster_by or {}

    def complete(name: str) -> bool:
        places = (path(f"{root}/{name}", version) for path in (snapshot_path, manifest_path))
        return any(is_complete(spark, place) for place in places)

    def earlier(name: str) -> DataFrame | None:
        return read_star(spark, root, name, version - 1) if version > 1 else None

    def write(name: str, df: DataFrame) -> DataFrame:
        if not complete(name):
            write_snapshot(df, f"{root}/{name}", version, partition_by.get(name, ()), cluster_by.get(name, ()))
        return read_star(spark, root, name, version)

    def by_folder(name: str) -> bool:
        """Whether the table's folders are written one by one."""
        return version > 1 and len(partition_by.get(name, ())) == 1

    bounds = silver["orders"].agg(
        F.min("order_date").cast("date").alias("first_day"), F.max("order_date").cast("date").alias("last_day")
    )
    for name, day in (("first_day", first_day), ("last_day", last_day)):
        if day is not None:
            bounds = bounds.withColumn(name, F.lit(day).cast("date"))
    made = dimensions.dim_date(dates_between(bounds))
    before = earlier("dim_date")
    if before is not None:
        made = made.unionByName(before.join(made, "dim_date_key", "left_anti").select(*made.columns))
    days = write("dim_date", made)
    products = write(
        "dim_product",
        dimensions.with_unknown_product(
            dimensions.dim_product(
                earlier("dim_product"),
                silver["products"],
                silver["brands"],
                silver["categories"],
                run_id,
                as_of,
            )
        ),
    )
    customers = write(
        "dim_customer",
        dimensions.dim_customer(earlier("dim_customer"), silver["customers"], run_id, as_of),
    )
    locations = write(
        "dim_location",
        dimensions.with_unknown_location(
            dimensions.dim_location(
                earlier("dim_location"), silver["addresses"], silver["city_tiers"], run_id, as_of
            )
        ),
    )
    dims = {
        "dim_customer_key": customers.filter("_is_current"),
        "dim_location_key": locations,
        "dim_product_key": products,
    }
    orders = stored(facts.fact_orders(silver["orders"], customers, locations, run_id, as_of), "orders")
    # Stored with the business keys they were looked up by, so open references need not join them again.
    sold = stored(
        facts.fact_order_lines(
            silver["order_lines"], silver["orders"], products, customers, run_id, as_of,
            carry=[r.source_column for r in LINE_REFERENCES],
        ),
        "lines",
    )
    lines = sold.select(*STAR_SCHEMA["fact_order_lines"].names)
    if lines_from is None:
        lines_from = bounds.select(date_key("first_day")).first()[0] or 0
    day, nothing = "dim_date_key", stored(orders.limit(0), "none")

    def waiting(name: str, keys: list[str], references) -> tuple[DataFrame, DataFrame] | None:
        """What the build before left open, and what of it has its dimension row now."""
        if version == 1 or not is_complete(spark, snapshot_path(f"{root}/open_{name}", version - 1)):
            return None
        still = read_snapshot(spark, f"{root}/open_{name}", version - 1)
        return still, resolved_references(still, references, dims)

    def keep_open(name: str, rows: DataFrame) -> None:
        if not is_complete(spark, snapshot_path(f"{root}/open_{name}", version)):
            write_snapshot(rows, f"{root}/open_{name}", version)

    key, schema = ["order_number"], STAR_SCHEMA["fact_orders"]
    late = waiting("fact_orders", key, ORDER_REFERENCES)
    rekeyed_orders = nothing
    if late:
        names = partition_names(spark, late[1], [day])
        if by_folder("fact_orders") and partition_by["fact_orders"] == (day,):
            before_facts = facts_of(spark, f"{root}/fact_orders", version - 1, names, schema)
        else:
            before_facts = earlier("fact_orders")
        found = rekeyed(before_facts, key, ORDER_REFERENCES, late[1], only=True)
        rekeyed_orders = found.join(orders.select(*key), key, "left_anti").select(*schema.names)
    written = orders.unionByName(rekeyed_orders)
    if by_folder("fact_orders"):
        (folder,) = partition_by["fact_orders"]
        upsert_version(written, key, folder, f"{root}/fact_orders", version, schema=schema)
    else:
        write("fact_orders", facts.upsert_orders(earlier("fact_orders"), written))
    opened = open_references(orders, silver["orders"], key, day, ORDER_REFERENCES)
    keep_open(
        "fact_orders", next_open_references(still_open(*late, key), opened, orders, key) if late else opened
    )

    key, schema = ["order_number", "line_number"], STAR_SCHEMA["fact_order_lines"]
    late = waiting("fact_order_lines", key, LINE_REFERENCES)
    dated = lines.filter(F.col(day).isNotNull())
    undated = facts.undated_lines(earlier("fact_order_lines"), lines, silver["orders"])
    if late:
        undated = rekeyed(undated, key, LINE_REFERENCES, late[1])
    if by_folder("fact_order_lines") and partition_by["fact_order_lines"] == (day,):
        further = None
        if late:
            # Lines from the bound on are new anyway.
            names = partition_names(spark, late[1].filter(F.col(day) < lines_from), [day])
            further = rekeyed(facts_of(spark, f"{root}/fact_order_lines", version - 1, names, schema), key, LINE_REFERENCES, late[1]), names
        replace_version(dated, day, lines_from, f"{root}/fact_order_lines", version, without_value=undated, further=further)
    else:
        older = earlier("fact_order_lines")
        older = None if older is None else older.filter(F.col(day).isNotNull())
        if late:
            older = rekeyed(older, key, LINE_REFERENCES, late[1])
        write("fact_order_lines", replace_where(older, dated, f"{day} >= {lines_from}").unionByName(undated))
    opened = open_references(sold, None, key, day, LINE_REFERENCES)
    if late:
        left = still_open(*late, key).filter(F.coalesce(F.col(day) < lines_from, F.lit(True)))
        opened = next_open_references(left, opened, silver["orders"], ["order_number"])
    keep_open("fact_order_lines", opened)

    if database:
        create_database(spark, database)
        for name in ("fact_orders", "fact_order_lines"):
            publish(spark, f"{database}.{name}", f"{root}/{name}", version)

    orders, lines = (read_star(spark, root, name, version) for name in ("fact_orders", "fact_order_lines"))
    # The upsert lets an order number in once only, so months count orders without shuffling the numbers.
    if partition_by.get("fact_orders") == (day,):
        # Days the dimension did not know before bring in facts that were left out.
        also: list[int] = []
        if before is not None:
            added = days.join(before, "dim_date_key", "left_anti").select(month_key("full_date")).distinct()
            also = [row[0] for row in added.collect()]
        months = snapshots.maintain_customer_months(
            spark, f"{root}/fact_orders", f"{root}/customer_months", version, days, also=also, unique_orders=True
        )
        snapshot = snapshots.snapshot_of_months(months, run_id, as_of)
    else:
        snapshot = snapshots.customer_monthly_snapshot(orders, days, run_id, as_of, unique_orders=True)
    snapshot = write("agg_customer_monthly_snapshot", snapshot)
    return {
        "dim_date": days,
        "dim_product": products,
        "dim_customer": customers,
        "dim_location": locations,
        "fact_orders": orders,
        "fact_order_lines": lines,
        "agg_customer_monthly_snapshot": snapshot,
    }


def register_star(spark: SparkSession, database: str, root: str, version: int, location: str | None = None) -> None:
    """Catalog entries for one stored version: the tables as external tables."""
    create_database(spark, database, location)
    for name, schema in STAR_SCHEMA.items():
        register_version(
            spark, f"{database}.{name}", schema, f"{root}/{name}", version, PARTITIONED_BY.get(name, ())
        )


def publish_star(spark: SparkSession, database: str, root: str, version: int) -> None:
    """Point the readers of every table at ``version`` (views, replaced one by one)."""
    create_database(spark, database)
    for name in STAR_SCHEMA:
        publish(spark, f"{database}.{name}", f"{root}/{name}", version)
