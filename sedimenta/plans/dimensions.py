"""Dimensions of the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.columns import any_differs, conform, date_key, moment, with_audit
from sedimenta.operators.history import current_rows
from sedimenta.operators.keys import UNKNOWN_KEY, greatest_key, with_surrogate_key, with_unknown_member
from sedimenta.operators.merge import unique_rows, upsert_keeping
from sedimenta.plans.schemas import DIM_CUSTOMER, DIM_DATE, DIM_LOCATION, DIM_PRODUCT

# Placeholders the published tables carry.
CATEGORY_LEVEL_1 = "Level 1"
CATEGORY_LEVEL_2 = "Level 2"
SEGMENT_FIRST_LOAD = "New"
SEGMENT_LATER_LOAD = "Recalculate"
WEEKEND_DAYS = (1, 7)  # Sunday is 1
CUSTOMER_ATTRIBUTES = (
    "customer_id",
    "email",
    "first_name",
    "last_name",
    "gender",
    "date_of_birth",
    "registration_date",
    "customer_type",
    "status",
)
CUSTOMER_TRACKED = ("customer_type", "status")
UNKNOWN_CUSTOMER = {
    "customer_id": UNKNOWN_KEY,
    "email": "UNKNOWN",
    "first_name": "Unknown",
    "last_name": "Customer",
    "gender": "U",
    "customer_type": "Standard",
    "status": "Active",
    "rfm_segment": "Unknown",
    "_is_current": True,
    "_version": 1,
}


UNKNOWN_PRODUCT = {
    "product_id": UNKNOWN_KEY,
    "sku": "UNKNOWN",
    "product_name": "Unknown",
    "brand_name": "Unknown",
    "category_name": "Unknown",
}
UNKNOWN_LOCATION = {"address_id": UNKNOWN_KEY, "city": "Unknown", "state": "Unknown"}


def with_unknown_product(dim: DataFrame) -> DataFrame:
    """The row that lines of unknown products point at."""
    return with_unknown_member(dim, "dim_product_key", UNKNOWN_PRODUCT)


def with_unknown_location(dim: DataFrame) -> DataFrame:
    """The row that orders to unknown addresses point at."""
    return with_unknown_member(dim, "dim_location_key", UNKNOWN_LOCATION)


def dim_date(days: DataFrame) -> DataFrame:
    """One row per day of ``days`` (column ``full_date``)."""
    day = F.col("full_date")
    return conform(
        days.select(
            date_key(day).alias("dim_date_key"),
            day,
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month_number"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.weekofyear(day).alias("week_of_year"),
            F.dayofweek(day).alias("day_of_week"),
            F.date_format(day, "EEEE").alias("day_name"),
            F.dayofweek(day).isin(*WEEKEND_DAYS).alias("is_weekend"),
            F.lit(False).alias("is_holiday"),
        ),
        DIM_DATE,
    )


def product_rows(
    products: DataFrame,
    brands: DataFrame,
    categories: DataFrame,
    run_id: str,
    as_of: Column | dt.datetime | str,
) -> DataFrame:
    """Products flattened with brand and category; either may be missing."""
    flat = (
        products.join(brands.select("brand_id", "brand_name", "brand_tier"), "brand_id", "left")
        .join(categories.select("category_id", "category_name"), "category_id", "left")
        .withColumns(
            {
                "dim_product_key": F.col("product_id"),
                "product_name": F.col("item_name"),
                "category_level_1": F.lit(CATEGORY_LEVEL_1),
                "category_level_2": F.lit(CATEGORY_LEVEL_2),
            }
        )
    )
    return conform(with_audit(flat, run_id, {"_created_date": as_of}), DIM_PRODUCT)


def dim_product(
    target: DataFrame | None,
    products: DataFrame,
    brands: DataFrame,
    categories: DataFrame,
    run_id: str,
    as_of: Column | dt.datetime | str,
) -> DataFrame:
    """Upsert by product.  A known product keeps its key and creation time."""
    rows = product_rows(products, brands, categories, run_id, as_of)
    return upsert_keeping(target, rows, ["product_id"], ["dim_product_key", "_created_date"], {})


def dim_location(
    target: DataFrame | None,
    addresses: DataFrame,
    city_tiers: DataFrame,
    run_id: str,
    as_of: Column | dt.datetime | str,
) -> DataFrame:
    """Upsert by address; tier, metro flag and region come from the (city, state) master."""
    tiers = city_tiers.select("city", "state", "city_tier", "is_metro", "region")
    rows = addresses.join(tiers, ["city", "state"], "left").withColumn("dim_location_key", F.col("address_id"))
    rows = conform(with_audit(rows, run_id, {"_created_date": as_of}), DIM_LOCATION)
    return upsert_keeping(target, rows, ["address_id"], ["dim_location_key", "_created_date"], {})


def _customer_versions(
    rows: DataFrame, segment: str, version: Column, run_id: str, as_of: Column | dt.datetime | str
) -> DataFrame:
    opened = rows.withColumns(
        {
            "rfm_segment": F.lit(segment),
            "_valid_from": moment(as_of),
            "_valid_to": F.lit(None).cast("timestamp"),
            "_is_current": F.lit(True),
            "_version": version,
        }
    )
    return with_audit(opened, run_id, {"_created_date": as_of})


def dim_customer_initial(
    customers: DataFrame, run_id: str, as_of: Column | dt.datetime | str, partitions: int | None = None
) -> DataFrame:
    """First load: dense keys in customer order, plus the unknown customer."""
    rows = _customer_versions(
        unique_rows(customers.select(*CUSTOMER_ATTRIBUTES), ["customer_id"]), SEGMENT_FIRST_LOAD, F.lit(1), run_id, as_of
    )
    keyed = with_surrogate_key(rows, ["customer_id"], "dim_customer_key", partitions=partitions)
    return with_unknown_member(conform(keyed, DIM_CUSTOMER), "dim_customer_key", UNKNOWN_CUSTOMER)


def dim_customer_apply(
    target: DataFrame,
    customers: DataFrame,
    run_id: str,
    as_of: Column | dt.datetime | str,
    partitions: int | None = None,
) -> DataFrame:
    """Later load: a change in a tracked attribute closes the version and opens the next.

    The new rows are numbered (and thereby stored) once; which current rows to
    close is then read off that table instead of comparing everything again.
    """
    live = current_rows(target).select("customer_id", *CUSTOMER_TRACKED, "_version").alias("t")
    incoming = unique_rows(customers.select(*CUSTOMER_ATTRIBUTES), ["customer_id"]).alias("s")
    unseen = F.col("t._version").isNull()
    opening = (
        incoming.join(live, F.col("s.customer_id") == F.col("t.customer_id"), "left")
        .filter(unseen | any_differs("s", "t", CUSTOMER_TRACKED))
        .select("s.*", (F.coalesce(F.col("t._version"), F.lit(0)) + 1).alias("_next"))
    )
    versions = _customer_versions(opening, SEGMENT_LATER_LOAD, F.col("_next"), run_id, as_of).drop("_next")
    opened = conform(
        with_surrogate_key(
            versions,
            ["customer_id"],
            "dim_customer_key",
            after=greatest_key(target, "dim_customer_key"),
            partitions=partitions,
        ),
        DIM_CUSTOMER,
    )

    closing = opened.filter("_version > 1").select(F.col("customer_id").alias("_closing"))
    is_live = F.coalesce(F.col("_is_current"), F.lit(False))
    closed = F.col("_closing").isNotNull()
    stamp = moment(as_of, target.schema["_valid_to"].dataType)
    kept = (
        target.filter(is_live)
        .join(closing, F.col("customer_id") == F.col("_closing"), "left")
        .withColumns(
            {
                "_is_current": ~closed,
                "_valid_to": F.when(closed, stamp).otherwise(F.col("_valid_to")),
            }
        )
        .drop("_closing")
    )
    return target.filter(~is_live).unionByName(kept).unionByName(opened)


def dim_customer(
    target: DataFrame | None,
    customers: DataFrame,
    run_id: str,
    as_of: Column | dt.datetime | str,
    partitions: int | None = None,
) -> DataFrame:
    if target is None:
        return dim_customer_initial(customers, run_id, as_of, partitions)
    return dim_customer_apply(target, customers, run_id, as_of, partitions)
