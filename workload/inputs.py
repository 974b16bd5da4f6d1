"""Inputs derived from the given tables.

Each input is stated once, as SQL expressions both engines read alike: Spark
selects them from the parquet table, the oracle puts the same text into a CTE.
All inputs cover their whole table.  Where a situation needs missing parents or
unseen keys, some rows' keys are shifted to values that nothing else has; no row
is left out.  Only the order profiles are cut by date, and every query that uses
them takes profiles that together cover all orders.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Load times and cut-off days of the scenarios.
FIRST_LOAD = "1997-07-01 00:00:00"
SECOND_LOAD = "1999-07-01 00:00:00"
THIRD_LOAD = "2001-08-02 00:00:00"
AS_OF_DAY = "2001-08-01 00:00:00"
CHANGE_LOAD = "2024-02-01 00:00:00"
RUN_1, RUN_2, RUN_3 = "run-1", "run-2", "run-3"


@dataclass(frozen=True)
class Input:
    table: str
    columns: tuple[str, ...]
    where: str | None = None
    distinct: bool = False

    @property
    def sql(self) -> str:
        kind = "SELECT DISTINCT" if self.distinct else "SELECT"
        where = f" WHERE {self.where}" if self.where else ""
        return f"{kind} {', '.join(self.columns)} FROM {self.table}{where}"

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = spark.read.parquet(f"{sf_dir}/{self.table}.parquet")
        if self.where:
            df = df.filter(self.where)
        df = df.selectExpr(*self.columns)
        return df.distinct() if self.distinct else df


# Added to keys that are to match nothing.
ELSEWHERE = 1_000_000_000


def shifted(key: str, condition: str) -> str:
    return f"CASE WHEN {condition} THEN {key} + {ELSEWHERE} ELSE {key} END"


_TOTAL = "CAST(o_totalprice AS DECIMAL(18,2))"


def _profile(period: str | None) -> Input:
    """Customers as their orders of a period describe them (several rows per customer)."""
    return Input(
        "orders",
        (
            "o_custkey AS customer_id",
            "'customer' || CAST(o_custkey AS STRING) || '@example.com' AS email",
            "'Customer' AS first_name",
            "CAST(o_custkey AS STRING) AS last_name",
            "'U' AS gender",
            "DATE '1970-01-01' AS date_of_birth",
            "TIMESTAMP '1995-01-01 00:00:00' AS registration_date",
            "nullif(o_orderpriority, '3-MEDIUM') AS customer_type",
            "o_orderstatus AS status",
            "o_orderkey AS last_order_id",
            "o_orderdate AS last_order_date",
        ),
        period,
    )


_BUILDING = "c_mktsegment = 'BUILDING'"

INPUTS: dict[str, Input] = {
    # raw layer
    "changes": Input(
        "events",
        (
            "user_id",
            "value",
            "CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN 2 WHEN 'view' THEN 3 WHEN 'click' THEN 4 "
            "ELSE 9 END AS _cdc_operation_code",
            "CAST(floor(event_id / 4) AS BIGINT) AS _cdc_version",
            "event_id AS _cdc_seq",
            "ts AS _change_timestamp",
        ),
    ),
    "accounts": Input(
        "customer", (f"{shifted('c_custkey', _BUILDING)} AS user_id", "c_acctbal AS value")
    ),
    # conformed layer
    "raw_customers": Input(
        "customer",
        (
            "c_custkey AS customer_id",
            "'  ' || c_name || ' ' AS name",
            "CASE c_mktsegment WHEN 'MACHINERY' THEN '  ' WHEN 'FURNITURE' THEN lower(c_name) "
            "ELSE '  ' || lower(replace(c_name, '#', '.')) || '@example.com ' END AS email",
            "CASE WHEN c_nationkey = 5 THEN '   ' ELSE c_mktsegment END AS customer_type",
            "CASE WHEN c_acctbal < 1000 THEN 'Dormant' ELSE 'Active' END AS status",
            "CASE WHEN c_nationkey = 3 THEN NULL ELSE c_acctbal END AS balance",
        ),
    ),
    "earlier_customers": Input(
        "customer",
        (
            f"{shifted('c_custkey', 'c_nationkey = 7')} AS customer_id",
            "c_name AS name",
            "lower(replace(c_name, '#', '.')) || '@example.com' AS email",
            "c_mktsegment AS customer_type",
            "'Active' AS status",
            "c_acctbal AS balance",
        ),
    ),
    "profile_1": _profile(f"o_orderdate < TIMESTAMP '{FIRST_LOAD}'"),
    "profile_2": _profile(
        f"o_orderdate >= TIMESTAMP '{FIRST_LOAD}' AND o_orderdate < TIMESTAMP '{SECOND_LOAD}'"
    ),
    "profile_3": _profile(f"o_orderdate >= TIMESTAMP '{SECOND_LOAD}'"),
    "profile_later": _profile(f"o_orderdate >= TIMESTAMP '{FIRST_LOAD}'"),
    "profile_all": _profile(None),
    # star schema
    "silver_orders": Input(
        "orders",
        (
            "o_orderkey AS order_id",
            "'ORD-' || CAST(o_orderkey AS STRING) AS order_number",
            "o_custkey AS customer_id",
            "o_custkey AS shipping_address_id",
            "o_orderdate AS order_date",
            "CASE o_orderstatus WHEN 'P' THEN 'Draft' WHEN 'F' THEN 'Delivered' ELSE 'Shipped' END AS order_status",
            "o_orderpriority AS payment_method",
            f"{_TOTAL} AS total_amount",
            f"CAST({_TOTAL} * 0.85 AS DECIMAL(18,2)) AS subtotal_amount",
            f"CAST({_TOTAL} * 0.10 AS DECIMAL(18,2)) AS discount_amount",
            f"CAST({_TOTAL} * 0.20 AS DECIMAL(18,2)) AS tax_amount",
            f"CAST({_TOTAL} * 0.05 AS DECIMAL(18,2)) AS shipping_amount",
        ),
    ),
    "silver_lines": Input(
        "lineitem",
        (
            "'ORD-' || CAST(l_orderkey AS STRING) AS order_number",
            "l_linenumber AS line_number",
            "l_partkey AS product_id",
            "l_quantity AS quantity",
            "l_extendedprice AS line_amount",
            "floor(l_extendedprice / l_quantity) AS unit_price",
        ),
    ),
    "products": Input(
        "part",
        (
            "p_partkey AS product_id",
            "'SKU-' || CAST(p_partkey AS STRING) AS sku",
            "p_name AS item_name",
            "p_retailprice AS list_price",
            "p_brand AS brand_id",
            "p_type AS category_id",
        ),
    ),
    "earlier_products": Input(
        "part",
        (
            f"{shifted('p_partkey', 'p_size > 25')} AS product_id",
            "'OLD-' || CAST(p_partkey AS STRING) AS sku",
            "p_name AS item_name",
            "p_retailprice AS list_price",
            "p_brand AS brand_id",
            "p_type AS category_id",
        ),
    ),
    "brands": Input(
        "part",
        (
            "CASE WHEN p_brand = 'Brand#9' THEN 'Brand#9 renamed' ELSE p_brand END AS brand_id",
            "lower(p_brand) AS brand_name",
            "CASE WHEN p_brand < 'Brand#20' THEN 'Premium' ELSE 'Standard' END AS brand_tier",
        ),
        distinct=True,
    ),
    "categories": Input("part", ("p_type AS category_id", "lower(p_type) AS category_name"), distinct=True),
    "known_customers": Input(
        "customer",
        (
            f"{shifted('c_custkey', _BUILDING)} AS customer_id",
            "lower(replace(c_name, '#', '.')) || '@example.com' AS email",
            "'Customer' AS first_name",
            "substr(c_name, 10) AS last_name",
            "'U' AS gender",
            "DATE '1970-01-01' AS date_of_birth",
            "TIMESTAMP '1995-01-01 00:00:00' AS registration_date",
            "c_mktsegment AS customer_type",
            "CASE WHEN c_acctbal < 0 THEN 'Dormant' ELSE 'Active' END AS status",
        ),
    ),
    # The same customers once all are found under their own keys.
    "arrived_customers": Input(
        "customer",
        (
            "c_custkey AS customer_id",
            "lower(replace(c_name, '#', '.')) || '@example.com' AS email",
            "'Customer' AS first_name",
            "substr(c_name, 10) AS last_name",
            "'U' AS gender",
            "DATE '1970-01-01' AS date_of_birth",
            "TIMESTAMP '1995-01-01 00:00:00' AS registration_date",
            "c_mktsegment AS customer_type",
            "CASE WHEN c_acctbal < 0 THEN 'Dormant' ELSE 'Active' END AS status",
        ),
    ),
    # Customers as the parents of orders, as three loads in a row know them: the second adds some of those in
    # debt, the third loses a nation's.
    "parents_1": Input("customer", (f"{shifted('c_custkey', 'c_acctbal <= 0')} AS c_custkey",)),
    "parents_2": Input("customer", (f"{shifted('c_custkey', 'c_acctbal <= 0 AND c_nationkey >= 12')} AS c_custkey",)),
    "parents_3": Input(
        "customer", (f"{shifted('c_custkey', '(c_acctbal <= 0 AND c_nationkey >= 12) OR c_nationkey = 3')} AS c_custkey",)
    ),
    # Customers as the parents of orders; those in debt are not found under their key.
    "parents": Input("customer", (f"{shifted('c_custkey', 'c_acctbal <= 0')} AS c_custkey",)),
}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return INPUTS[name].frame(spark, sf_dir)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return (
        customer.join(table(spark, sf_dir, "nation"), customer["c_nationkey"] == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(
            "c_custkey AS address_id",
            "n_name AS city",
            "r_name AS state",
            "CAST(110000 + c_nationkey AS STRING) AS pincode",
        )
    )


_TIER_CITY = "CASE WHEN n_name = 'NATION_7' THEN 'NOWHERE' ELSE n_name END"


def city_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(
            f"{_TIER_CITY} AS city",
            "r_name AS state",
            "CASE WHEN n_nationkey < 8 THEN 1 WHEN n_nationkey < 16 THEN 2 ELSE 3 END AS city_tier",
            "n_nationkey < 8 AS is_metro",
            "r_name AS region",
        )
    )


_JOINED_SQL = {
    "addresses": """
        SELECT c_custkey AS address_id, n_name AS city, r_name AS state,
               CAST(110000 + c_nationkey AS STRING) AS pincode
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "city_tiers": """
        SELECT CASE WHEN n_name = 'NATION_7' THEN 'NOWHERE' ELSE n_name END AS city, r_name AS state,
               CASE WHEN n_nationkey < 8 THEN 1 WHEN n_nationkey < 16 THEN 2 ELSE 3 END AS city_tier,
               n_nationkey < 8 AS is_metro, r_name AS region
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
}


def with_inputs(names: list[str], ctes: str, body: str) -> str:
    """SQL text: the named inputs, further CTEs, and the final SELECT."""
    parts = [f"{n} AS ({_JOINED_SQL[n] if n in _JOINED_SQL else INPUTS[n].sql})" for n in names]
    if ctes.strip():
        parts.append(ctes.strip())
    return f"WITH {', '.join(parts)} {body}" if parts else body


def latest_sql(source: str, keys: str, order: str) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn "
        f"FROM {source}) WHERE rn = 1"
    )
