"""Declared column order and types of the star schema."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "bigint": LongType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "decimal(10,2)": DecimalType(10, 2),
    "decimal(18,2)": DecimalType(18, 2),
    "int": IntegerType(),
    "string": StringType(),
    "timestamp": TimestampType(),
}


def _schema(text: str) -> StructType:
    """``"name type, name type"`` as a schema (usable before a session exists)."""
    pairs = [column.split(" ") for column in text.split(", ")]
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


# Column names, order and types of the published tables.
DIM_CUSTOMER = _schema(
    "dim_customer_key bigint, customer_id bigint, email string, first_name string, last_name string, "
    "gender string, date_of_birth date, registration_date timestamp, customer_type string, status string, "
    "rfm_segment string, _valid_from timestamp, _valid_to timestamp, _is_current boolean, _version int, "
    "_created_date timestamp, _pipeline_run_id string"
)
DIM_PRODUCT = _schema(
    "dim_product_key bigint, product_id bigint, sku string, product_name string, list_price decimal(10,2), "
    "brand_name string, brand_tier string, category_name string, category_level_1 string, "
    "category_level_2 string, _created_date timestamp, _pipeline_run_id string"
)
DIM_LOCATION = _schema(
    "dim_location_key bigint, address_id bigint, city string, state string, pincode string, city_tier int, "
    "is_metro boolean, region string, _created_date timestamp, _pipeline_run_id string"
)
DIM_DATE = _schema(
    "dim_date_key int, full_date date, year int, quarter int, month_number int, month_name string, "
    "week_of_year int, day_of_week int, day_name string, is_weekend boolean, is_holiday boolean"
)
FACT_ORDERS = _schema(
    "dim_date_key int, dim_customer_key bigint, dim_location_key bigint, dim_campaign_key bigint, "
    "order_number string, order_status string, payment_method string, total_amount decimal(18,2), "
    "subtotal_amount decimal(18,2), discount_amount decimal(18,2), tax_amount decimal(18,2), "
    "shipping_amount decimal(18,2), is_delivered int, _created_date timestamp, _pipeline_run_id string"
)
FACT_ORDER_LINES = _schema(
    "dim_date_key int, dim_product_key bigint, dim_customer_key bigint, dim_order_key bigint, "
    "order_number string, line_number int, line_status string, quantity int, line_amount decimal(18,2), "
    "unit_price decimal(18,2), _created_date timestamp, _pipeline_run_id string"
)
CUSTOMER_MONTHLY_SNAPSHOT = _schema(
    "dim_customer_key bigint, month_key int, monthly_revenue decimal(18,2), monthly_orders int, "
    "monthly_discount decimal(18,2), lifetime_revenue decimal(18,2), lifetime_orders int, recency_days int, "
    "aov_lifetime decimal(18,2), _created_date timestamp, _pipeline_run_id string"
)

#: Partition column of each partitioned table.
PARTITIONED_BY = {
    "fact_orders": ("dim_date_key",),
    "fact_order_lines": ("dim_date_key",),
    "agg_customer_monthly_snapshot": ("month_key",),
}

STAR_SCHEMA = {
    "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT,
    "dim_location": DIM_LOCATION,
    "dim_date": DIM_DATE,
    "fact_orders": FACT_ORDERS,
    "fact_order_lines": FACT_ORDER_LINES,
    "agg_customer_monthly_snapshot": CUSTOMER_MONTHLY_SNAPSHOT,
}
