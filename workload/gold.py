"""Star schema, snapshots and reporting views."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.changes import latest_per_key
from sedimenta.operators.keys import greatest_key, with_surrogate_key, with_unknown_member
from sedimenta.plans import dimensions, facts, snapshots, views
from sedimenta.plans.late_keys import Reference, open_references, rekey_facts
from sedimenta.plans.schemas import STAR_SCHEMA
from sedimenta.plans.star import publish_star, run_star
from sedimenta.session import fresh_path, stored
from sedimenta.sinks.partitions import replace_version, upsert_version
from sedimenta.sinks.tables import create_database, publish, register_table, upsert_into_partitions, write_snapshot
from sedimenta.sources.tables import dates_between, read_snapshot, snapshot_path
from workload.inputs import (
    FIRST_LOAD,
    RUN_1,
    RUN_2,
    RUN_3,
    SECOND_LOAD,
    THIRD_LOAD,
    addresses,
    city_tiers,
    frame,
    latest_sql,
    table,
    with_inputs,
)
from workload.registry import query

# The day the reports are made; the product report looks back from here.
REPORT_DAY = "2001-08-01 00:00:00"
# The orders of a second, small build.
LATEST_ORDERS = "2001-06-01 00:00:00"

# ---- keys ----------------------------------------------------------------


@query(
    "surrogate_keys",
    """SELECT o_orderkey, o_custkey, o_orderdate,
              row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_sk FROM orders""",
)
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return with_surrogate_key(orders, ["o_orderdate", "o_orderkey"], "order_sk")


@query(
    "surrogate_keys_offset",
    """SELECT s_suppkey AS party_id, s_name AS party_name,
              row_number() OVER (ORDER BY s_suppkey) + (SELECT max(c_custkey) FROM customer) AS party_sk
       FROM supplier""",
)
def surrogate_keys_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS party_id", "s_name AS party_name")
    used = greatest_key(table(spark, sf_dir, "customer"), "c_custkey")
    return with_surrogate_key(suppliers, ["party_id"], "party_sk", after=used)


@query(
    "dim_unknown_member",
    """SELECT p_partkey AS dim_part_key, p_name AS part_name, p_brand AS brand FROM part
       UNION ALL SELECT -1, 'Unknown', NULL""",
)
def dim_unknown_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS dim_part_key", "p_name AS part_name", "p_brand AS brand"
    )
    added = with_unknown_member(parts, "dim_part_key", {"part_name": "Unknown"})
    return with_unknown_member(added, "dim_part_key", {"part_name": "Unknown"})


# ---- dimensions ------------------------------------------------------------

_DATES = """
bounds AS (SELECT CAST(min(o_orderdate) AS DATE) AS d0, CAST(max(o_orderdate) AS DATE) AS d1 FROM orders),
days AS (SELECT CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS full_date FROM bounds),
dim_date AS (
  SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS dim_date_key, full_date,
         CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
         CAST(month(full_date) AS INTEGER) AS month_number, monthname(full_date) AS month_name,
         CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
         CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week, dayname(full_date) AS day_name,
         dayofweek(full_date) IN (0, 6) AS is_weekend, FALSE AS is_holiday
  FROM days)
"""


def _dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = table(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").alias("first_day"), F.max("o_orderdate").alias("last_day")
    )
    return dimensions.dim_date(dates_between(bounds))


@query(
    "dim_date",
    f"WITH {_DATES} SELECT * REPLACE (CAST(full_date AS STRING) AS full_date) FROM dim_date",
)
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dim_date(spark, sf_dir)


def _product_sql(products: str, run: str, as_of: str) -> str:
    return f"""SELECT product_id AS dim_product_key, product_id, sku, item_name AS product_name,
                  CAST(list_price AS DECIMAL(10,2)) AS list_price, brand_name, brand_tier, category_name,
                  'Level 1' AS category_level_1, 'Level 2' AS category_level_2,
                  TIMESTAMP '{as_of}' AS _created_date, '{run}' AS _pipeline_run_id
           FROM {products} LEFT JOIN brands USING (brand_id) LEFT JOIN categories USING (category_id)"""


_PRODUCT = f"dim_product AS ({_product_sql('products', RUN_1, FIRST_LOAD)})"
_MONEY = "CAST(list_price AS DOUBLE) AS list_price"


def _product_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return frame(spark, sf_dir, "brands"), frame(spark, sf_dir, "categories")


def _dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = frame(spark, sf_dir, "products")
    return dimensions.dim_product(None, products, *_product_inputs(spark, sf_dir), RUN_1, FIRST_LOAD)


@query(
    "dim_product",
    with_inputs(["products", "brands", "categories"], _PRODUCT, f"SELECT * REPLACE ({_MONEY}) FROM dim_product"),
)
def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dim_product(spark, sf_dir)


@query(
    "dim_product_upsert",
    with_inputs(
        ["products", "earlier_products", "brands", "categories"],
        f"""older AS (SELECT * REPLACE (dim_product_key + 1000000 AS dim_product_key)
                      FROM ({_product_sql('earlier_products', RUN_1, FIRST_LOAD)})),
            newer AS ({_product_sql('products', RUN_2, SECOND_LOAD)})""",
        """SELECT n.* REPLACE (coalesce(o.dim_product_key, n.product_id) AS dim_product_key,
                               coalesce(o._created_date, n._created_date) AS _created_date,
                               CAST(n.list_price AS DOUBLE) AS list_price)
           FROM newer n LEFT JOIN older o ON o.product_id = n.product_id
           UNION ALL SELECT * REPLACE (CAST(list_price AS DOUBLE) AS list_price) FROM older
           WHERE product_id NOT IN (SELECT product_id FROM newer)""",
    ),
)
def dim_product_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands, categories = _product_inputs(spark, sf_dir)
    older = dimensions.dim_product(
        None, frame(spark, sf_dir, "earlier_products"), brands, categories, RUN_1, FIRST_LOAD
    ).withColumn("dim_product_key", F.col("dim_product_key") + 1000000)
    products = frame(spark, sf_dir, "products")
    return dimensions.dim_product(older, products, brands, categories, RUN_2, SECOND_LOAD)


_LOCATION = f"""
dim_location AS (
  SELECT address_id AS dim_location_key, address_id, city, state, pincode, city_tier, is_metro, region,
         TIMESTAMP '{FIRST_LOAD}' AS _created_date, '{RUN_1}' AS _pipeline_run_id
  FROM addresses LEFT JOIN city_tiers USING (city, state))
"""


def _dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_location(
        None, addresses(spark, sf_dir), city_tiers(spark, sf_dir), RUN_1, FIRST_LOAD
    )


@query(
    "dim_product_unknown",
    with_inputs(
        ["products", "brands", "categories"],
        _PRODUCT,
        f"""SELECT * REPLACE ({_MONEY}) FROM dim_product UNION ALL
            SELECT -1, -1, 'UNKNOWN', 'Unknown', NULL, 'Unknown', NULL, 'Unknown', NULL, NULL, NULL, NULL""",
    ),
)
def dim_product_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.with_unknown_product(_dim_product(spark, sf_dir))


@query(
    "dim_location_unknown",
    with_inputs(
        ["addresses", "city_tiers"],
        _LOCATION,
        """SELECT * FROM dim_location UNION ALL
           SELECT -1, -1, 'Unknown', 'Unknown', NULL, NULL, NULL, NULL, NULL, NULL""",
    ),
)
def dim_location_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.with_unknown_location(_dim_location(spark, sf_dir))


@query("dim_location", with_inputs(["addresses", "city_tiers"], _LOCATION, "SELECT * FROM dim_location"))
def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dim_location(spark, sf_dir)


_ATTRIBUTES = ", ".join(dimensions.CUSTOMER_ATTRIBUTES)
_CUSTOMER = f"""
dim_customer AS (
  SELECT row_number() OVER (ORDER BY customer_id) AS dim_customer_key, {_ATTRIBUTES}, 'New' AS rfm_segment,
         TIMESTAMP '{FIRST_LOAD}' AS _valid_from, CAST(NULL AS TIMESTAMP) AS _valid_to, TRUE AS _is_current,
         1 AS _version, TIMESTAMP '{FIRST_LOAD}' AS _created_date, '{RUN_1}' AS _pipeline_run_id
  FROM known_customers
  UNION ALL
  SELECT -1, -1, 'UNKNOWN', 'Unknown', 'Customer', 'U', NULL, NULL, 'Standard', 'Active', 'Unknown', NULL, NULL,
         TRUE, 1, NULL, NULL)
"""


def _dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_customer(None, frame(spark, sf_dir, "known_customers"), RUN_1, FIRST_LOAD)


def _later_load_sql(target: str, source: str, run: str, as_of: str) -> str:
    """Next state of the customer dimension, stated set by set."""
    fresh = f"""
      SELECT s.*, coalesce(t._version, 0) + 1 AS _version FROM {source} s
      LEFT JOIN (SELECT * FROM {target} WHERE _is_current) t ON t.customer_id = s.customer_id
      WHERE t.customer_id IS NULL OR t.customer_type IS DISTINCT FROM s.customer_type
            OR t.status IS DISTINCT FROM s.status"""
    closing = f"(SELECT customer_id FROM ({fresh}) WHERE _version > 1)"
    return f"""
      SELECT * REPLACE (
        CASE WHEN _is_current AND customer_id IN {closing} THEN TIMESTAMP '{as_of}' ELSE _valid_to END AS _valid_to,
        _is_current AND customer_id NOT IN {closing} AS _is_current) FROM {target}
      UNION ALL
      SELECT row_number() OVER (ORDER BY customer_id) + (SELECT max(dim_customer_key) FROM {target}),
             {_ATTRIBUTES}, 'Recalculate', TIMESTAMP '{as_of}', NULL, TRUE, _version, TIMESTAMP '{as_of}', '{run}'
      FROM ({fresh})"""


def _profile_sql(name: str) -> str:
    latest = latest_sql(name, "customer_id", "last_order_date DESC, last_order_id DESC")
    return f"SELECT {_ATTRIBUTES} FROM ({latest})"


def _profile(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    newest = latest_per_key(
        frame(spark, sf_dir, name), ["customer_id"], ("last_order_date", "last_order_id")
    )
    return newest.select(*dimensions.CUSTOMER_ATTRIBUTES)


@query(
    "dim_customer_scd2",
    with_inputs(
        ["profile_1", "profile_2", "profile_3"],
        f"""p1 AS ({_profile_sql('profile_1')}), p2 AS ({_profile_sql('profile_2')}),
            p3 AS ({_profile_sql('profile_3')}),
            d1 AS (SELECT * FROM ({_CUSTOMER.strip().removeprefix('dim_customer AS ').replace('known_customers', 'p1')})),
            d2 AS ({_later_load_sql('d1', 'p2', RUN_2, SECOND_LOAD)}),
            d3 AS ({_later_load_sql('d2', 'p3', RUN_3, THIRD_LOAD)})""",
        "SELECT * REPLACE (CAST(date_of_birth AS STRING) AS date_of_birth) FROM d3",
    ),
)
def dim_customer_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = dimensions.dim_customer(None, _profile(spark, sf_dir, "profile_1"), RUN_1, FIRST_LOAD)
    state = stored(state, "customers")  # as in a run of builds: each reads the stored table before
    state = dimensions.dim_customer(state, _profile(spark, sf_dir, "profile_2"), RUN_2, SECOND_LOAD)
    state = stored(state, "customers")
    return dimensions.dim_customer(state, _profile(spark, sf_dir, "profile_3"), RUN_3, THIRD_LOAD)


# ---- facts -------------------------------------------------------------------

_FACT_ORDERS = f"""
{_CUSTOMER}, {_LOCATION},
fact_orders AS (
  SELECT CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS dim_date_key,
         coalesce(c.dim_customer_key, -1) AS dim_customer_key, coalesce(l.dim_location_key, -1) AS dim_location_key,
         CAST(-1 AS BIGINT) AS dim_campaign_key, order_number, order_status, payment_method,
         total_amount, subtotal_amount, discount_amount, tax_amount, shipping_amount,
         CASE WHEN order_status = 'Delivered' THEN 1 ELSE 0 END AS is_delivered,
         TIMESTAMP '{THIRD_LOAD}' AS _created_date, '{RUN_3}' AS _pipeline_run_id
  FROM silver_orders o
  LEFT JOIN (SELECT customer_id, dim_customer_key FROM dim_customer WHERE _is_current) c
         ON o.customer_id = c.customer_id
  LEFT JOIN dim_location l ON o.shipping_address_id = l.address_id
  WHERE order_status <> 'Draft')
"""
_ORDER_INPUTS = ["silver_orders", "known_customers", "addresses", "city_tiers"]
_AMOUNTS = ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}"
    for c in ("total_amount", "subtotal_amount", "discount_amount", "tax_amount", "shipping_amount")
)


def _fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = frame(spark, sf_dir, "silver_orders")
    return facts.fact_orders(
        orders, _dim_customer(spark, sf_dir), _dim_location(spark, sf_dir), RUN_3, THIRD_LOAD
    )


@query("fact_orders", with_inputs(_ORDER_INPUTS, _FACT_ORDERS, f"SELECT * REPLACE ({_AMOUNTS}) FROM fact_orders"))
def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact_orders(spark, sf_dir)


_UPSERT = with_inputs(
    _ORDER_INPUTS,
    f"""{_FACT_ORDERS},
        older AS (SELECT * FROM fact_orders WHERE dim_date_key < 20010101),
        newer AS (SELECT * REPLACE (1 AS is_delivered, 'Delivered' AS order_status) FROM fact_orders
                  WHERE dim_date_key >= 20000101)""",
    f"""SELECT * REPLACE ({_AMOUNTS}) FROM (
          SELECT * FROM older WHERE order_number NOT IN (SELECT order_number FROM newer)
          UNION ALL SELECT * FROM newer)""",
)


def _two_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """An earlier order fact and a later batch that overlaps it."""
    built = stored(_fact_orders(spark, sf_dir), "facts")
    newer = built.filter("dim_date_key >= 20000101").withColumns(
        {"is_delivered": F.lit(1), "order_status": F.lit("Delivered")}
    )
    return built.filter("dim_date_key < 20010101"), newer


@query("fact_orders_upsert", _UPSERT)
def fact_orders_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    older, newer = _two_loads(spark, sf_dir)
    return facts.upsert_orders(stored(older, "facts"), newer)


@query("fact_orders_partition_upsert", _UPSERT)
def fact_orders_partition_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same upsert into a catalog table by month, of which only the touched months are rewritten."""
    older, newer = (
        df.withColumn("month_key", (F.col("dim_date_key") / 100).cast("int")) for df in _two_loads(spark, sf_dir)
    )
    root, database = fresh_path(spark, "facts"), f"facts_{uuid.uuid4().hex}"
    first = write_snapshot(older, root, 1, ["month_key"])
    create_database(spark, database, f"{root}-database")
    register_table(spark, f"{database}.orders", first.schema, snapshot_path(root, 1), ["month_key"])
    upsert_into_partitions(f"{database}.orders", newer, ["order_number"], "month_key", root, 2)
    return spark.table(f"{database}.orders").select(*_fact_columns())


_VERSIONS = with_inputs(
    _ORDER_INPUTS,
    f"""{_FACT_ORDERS},
        v1 AS (SELECT * FROM fact_orders WHERE dim_date_key < 20010101),
        newer AS (SELECT * REPLACE (1 AS is_delivered, 'Delivered' AS order_status) FROM fact_orders
                  WHERE dim_date_key >= 20000101),
        v2 AS (SELECT * FROM v1 WHERE order_number NOT IN (SELECT order_number FROM newer) UNION ALL SELECT * FROM newer),
        v3 AS (SELECT * FROM v2 WHERE dim_date_key < 20010100
               UNION ALL SELECT * REPLACE ('Held' AS order_status) FROM v2
               WHERE dim_date_key >= 20010100 AND dim_date_key % 2 = 0)""",
    f"""SELECT * REPLACE ({_AMOUNTS}) FROM (
          SELECT 'version 1' AS state, * FROM v1 UNION ALL SELECT 'version 2', * FROM v2
          UNION ALL SELECT 'version 3', * FROM v3 UNION ALL SELECT 'published', * FROM v3)""",
)


@query("fact_versions", _VERSIONS)
def fact_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions by month, of which each load writes only its months; all of them and the published
    one read whole afterwards."""
    older, newer = (
        df.withColumn("month_key", (F.col("dim_date_key") / 100).cast("int")) for df in _two_loads(spark, sf_dir)
    )
    root, database = fresh_path(spark, "facts"), f"facts_{uuid.uuid4().hex}"
    create_database(spark, database, f"{root}-database")
    write_snapshot(older, root, 1, ["month_key"])
    second = upsert_version(newer, ["order_number"], "month_key", root, 2)
    held = second.filter("month_key >= 200101 AND dim_date_key % 2 = 0").withColumn("order_status", F.lit("Held"))
    replace_version(held, "month_key", 200101, root, 3)
    publish(spark, f"{database}.orders", root, 2)
    publish(spark, f"{database}.orders", root, 3)
    states = {f"version {v}": read_snapshot(spark, root, v, older.schema) for v in (1, 2, 3)}
    states["published"] = spark.table(f"{database}.orders")
    frames = [df.select(F.lit(name).alias("state"), *_fact_columns()) for name, df in states.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])


def _fact_columns() -> list[str]:
    return list(STAR_SCHEMA["fact_orders"].names)


@query(
    "fact_orders_rekeyed",
    with_inputs(
        [*_ORDER_INPUTS, "arrived_customers"],
        f"""{_FACT_ORDERS}, later AS ({_later_load_sql('dim_customer', 'arrived_customers', RUN_2, SECOND_LOAD)})""",
        f"""SELECT * REPLACE ({_AMOUNTS}) FROM (
              SELECT f.* REPLACE (CASE WHEN f.dim_customer_key = -1 THEN coalesce(l.dim_customer_key, -1)
                                       ELSE f.dim_customer_key END AS dim_customer_key)
              FROM fact_orders f JOIN silver_orders o ON f.order_number = o.order_number
              LEFT JOIN later l ON l._is_current AND l.customer_id = o.customer_id)""",
    ),
)
def fact_orders_rekeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders came before some customers: once those arrive, partitions with such orders get their keys."""
    root, orders = fresh_path(spark, "star"), frame(spark, sf_dir, "silver_orders")
    customers = stored(_dim_customer(spark, sf_dir), "customers")
    built = facts.fact_orders(orders, customers, _dim_location(spark, sf_dir), RUN_3, THIRD_LOAD)
    built = built.withColumn("month_key", (F.col("dim_date_key") / 100).cast("int"))
    first = write_snapshot(built, f"{root}/facts", 1, ["month_key"])
    customer = Reference("dim_customer_key", "customer_id", "customer_id")
    write_snapshot(open_references(first, orders, ["order_number"], "month_key", [customer]), f"{root}/open", 1)
    later = dimensions.dim_customer(customers, frame(spark, sf_dir, "arrived_customers"), RUN_2, SECOND_LOAD)
    rekeyed = rekey_facts(
        spark,
        f"{root}/facts",
        f"{root}/open",
        2,
        ["order_number"],
        "month_key",
        [customer],
        {"dim_customer_key": later.filter("_is_current")},
    )
    return rekeyed.select(*_fact_columns())


_FACT_LINES = f"""
{_CUSTOMER}, {_PRODUCT},
fact_order_lines AS (
  SELECT CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS dim_date_key,
         coalesce(p.dim_product_key, -1) AS dim_product_key, coalesce(c.dim_customer_key, -1) AS dim_customer_key,
         CAST(NULL AS BIGINT) AS dim_order_key, l.order_number, l.line_number, 'Closed' AS line_status,
         CAST(l.quantity AS INTEGER) AS quantity, CAST(l.line_amount AS DECIMAL(18,2)) AS line_amount,
         CAST(l.unit_price AS DECIMAL(18,2)) AS unit_price,
         TIMESTAMP '{THIRD_LOAD}' AS _created_date, '{RUN_3}' AS _pipeline_run_id
  FROM silver_lines l JOIN silver_orders o ON l.order_number = o.order_number
  LEFT JOIN dim_product p ON l.product_id = p.product_id
  LEFT JOIN (SELECT customer_id, dim_customer_key FROM dim_customer WHERE _is_current) c
         ON o.customer_id = c.customer_id)
"""
_LINE_INPUTS = [
    "silver_orders",
    "silver_lines",
    "known_customers",
    "products",
    "brands",
    "categories",
]


def _fact_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_order_lines(
        frame(spark, sf_dir, "silver_lines"),
        frame(spark, sf_dir, "silver_orders"),
        _dim_product(spark, sf_dir),
        _dim_customer(spark, sf_dir),
        RUN_3,
        THIRD_LOAD,
    )


@query(
    "fact_order_lines",
    with_inputs(
        _LINE_INPUTS,
        _FACT_LINES,
        """SELECT * REPLACE (CAST(line_amount AS DOUBLE) AS line_amount, CAST(unit_price AS DOUBLE) AS unit_price)
           FROM fact_order_lines""",
    ),
)
def fact_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact_order_lines(spark, sf_dir)


# ---- snapshot and views --------------------------------------------------------

_BASE = f"""
{_FACT_ORDERS}, {_DATES},
base AS (
  SELECT dim_customer_key, CAST(strftime(full_date, '%Y%m') AS INTEGER) AS month_key,
         CAST(sum(total_amount) AS DECIMAL(18,2)) AS monthly_revenue,
         CAST(count(DISTINCT order_number) AS INTEGER) AS monthly_orders,
         CAST(sum(discount_amount) AS DECIMAL(18,2)) AS monthly_discount,
         max(full_date) AS last_order_date_in_month
  FROM fact_orders JOIN dim_date USING (dim_date_key) GROUP BY 1, 2)
"""
_SNAPSHOT = f"""
{_BASE},
running AS (
  SELECT *, CAST(sum(monthly_revenue) OVER w AS DECIMAL(18,2)) AS lifetime_revenue,
         CAST(sum(monthly_orders) OVER w AS INTEGER) AS lifetime_orders
  FROM base
  WINDOW w AS (PARTITION BY dim_customer_key ORDER BY month_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
snapshot AS (
  SELECT dim_customer_key, month_key, monthly_revenue, monthly_orders, monthly_discount, lifetime_revenue,
         lifetime_orders,
         CAST(DATE '{THIRD_LOAD[:10]}' - last_order_date_in_month AS INTEGER) AS recency_days,
         -- round half up on whole cents, as decimal division does
         CAST((CAST(lifetime_revenue * 100 AS HUGEINT) * 2 + lifetime_orders) // (2 * lifetime_orders) AS DOUBLE) / 100
             AS aov_lifetime,
         TIMESTAMP '{THIRD_LOAD}' AS _created_date, '{RUN_3}' AS _pipeline_run_id
  FROM running)
"""


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.customer_monthly_snapshot(
        _fact_orders(spark, sf_dir), _dim_date(spark, sf_dir), RUN_3, THIRD_LOAD
    )


@query(
    "customer_monthly_base",
    with_inputs(
        _ORDER_INPUTS,
        _BASE,
        """SELECT * REPLACE (CAST(monthly_revenue AS DOUBLE) AS monthly_revenue,
                             CAST(monthly_discount AS DOUBLE) AS monthly_discount,
                             CAST(last_order_date_in_month AS STRING) AS last_order_date_in_month) FROM base""",
    ),
)
def customer_monthly_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.customer_monthly_base(_fact_orders(spark, sf_dir), _dim_date(spark, sf_dir))


@query(
    "customer_monthly_snapshot",
    with_inputs(
        _ORDER_INPUTS,
        _SNAPSHOT,
        """SELECT * REPLACE (CAST(monthly_revenue AS DOUBLE) AS monthly_revenue,
                             CAST(monthly_discount AS DOUBLE) AS monthly_discount,
                             CAST(lifetime_revenue AS DOUBLE) AS lifetime_revenue) FROM snapshot""",
    ),
)
def customer_monthly_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot(spark, sf_dir)


_MOVED = "CASE WHEN dim_customer_key % 7 = 0 THEN dim_date_key - 10000 ELSE dim_date_key END"
_INCREMENTAL = f"""
{_FACT_ORDERS},
older AS (SELECT * FROM fact_orders WHERE dim_date_key < 20010101),
newer AS (SELECT * REPLACE ({_MOVED} AS dim_date_key, CAST(total_amount + 1 AS DECIMAL(18,2)) AS total_amount)
          FROM fact_orders WHERE dim_date_key >= 20000101),
merged AS (SELECT * FROM older WHERE order_number NOT IN (SELECT order_number FROM newer)
           UNION ALL SELECT * FROM newer),
{_SNAPSHOT[_SNAPSHOT.index(_DATES.strip()[:20]):].replace("FROM fact_orders JOIN dim_date", "FROM merged JOIN dim_date")}
"""


@query(
    "customer_monthly_incremental",
    with_inputs(
        _ORDER_INPUTS,
        _INCREMENTAL,
        """SELECT * REPLACE (CAST(monthly_revenue AS DOUBLE) AS monthly_revenue,
                             CAST(monthly_discount AS DOUBLE) AS monthly_discount,
                             CAST(lifetime_revenue AS DOUBLE) AS lifetime_revenue) FROM snapshot""",
    ),
)
def customer_monthly_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of the facts that a load changed are summed again; running sums go on from those before."""
    built = stored(_fact_orders(spark, sf_dir), "facts")
    month = (F.col("dim_date_key") / 100).cast("int")
    older = built.filter("dim_date_key < 20010101")
    newer = built.filter("dim_date_key >= 20000101").withColumns(
        {"dim_date_key": F.expr(_MOVED), "total_amount": (F.col("total_amount") + 1).cast("decimal(18,2)")}
    )
    root, days = fresh_path(spark, "star"), stored(_dim_date(spark, sf_dir), "days")
    facts_root, state = f"{root}/facts", f"{root}/months"
    first = write_snapshot(older.withColumn("month_key", month), facts_root, 1, ["month_key"])
    upsert_version(newer.withColumn("month_key", month), ["order_number"], "month_key", facts_root, 2)
    for version in (1, 2):
        months = snapshots.maintain_customer_months(
            spark, facts_root, state, version, days, month_of=lambda m: m, facts_schema=first.schema
        )
    return snapshots.snapshot_of_months(months, RUN_3, THIRD_LOAD)


@query(
    "v_customer_360",
    with_inputs(
        _ORDER_INPUTS,
        _SNAPSHOT,
        """SELECT customer_id, first_name, last_name, customer_type, rfm_segment, month_key AS latest_activity_month,
                  CAST(lifetime_revenue AS DOUBLE) AS lifetime_revenue, lifetime_orders, aov_lifetime, recency_days
           FROM dim_customer JOIN snapshot USING (dim_customer_key)
           WHERE _is_current AND month_key = (SELECT max(month_key) FROM snapshot)""",
    ),
)
def v_customer_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _dim_customer(spark, sf_dir)
    orders = facts.fact_orders(
        frame(spark, sf_dir, "silver_orders"), customers, _dim_location(spark, sf_dir), RUN_3, THIRD_LOAD
    )
    snapshot = snapshots.customer_monthly_snapshot(orders, _dim_date(spark, sf_dir), RUN_3, THIRD_LOAD)
    # As in a build, the snapshot is a stored table by the time a view reads it (twice).
    return views.v_customer_360(customers, stored(snapshot, "snapshot"))


@query(
    "v_monthly_sales_trend",
    with_inputs(
        _ORDER_INPUTS,
        f"{_FACT_ORDERS}, {_DATES}",
        """SELECT year, month_name, month_number, CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
                  count(DISTINCT order_number) AS total_orders,
                  -- decimal average with six digits, rounded half up
                  CAST((CAST(sum(total_amount) * 1000000 AS HUGEINT) * 2 + count(*)) // (2 * count(*)) AS DOUBLE) / 1000000
                    AS aov
           FROM fact_orders JOIN dim_date USING (dim_date_key)
           GROUP BY year, month_name, month_number ORDER BY year DESC, month_number DESC""",
    ),
)
def v_monthly_sales_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.v_monthly_sales_trend(_fact_orders(spark, sf_dir), _dim_date(spark, sf_dir))


@query(
    "v_product_performance",
    with_inputs(
        _LINE_INPUTS,
        f"{_FACT_LINES}, {_DATES}",
        f"""SELECT category_name, brand_name, product_name, CAST(sum(quantity) AS BIGINT) AS units_sold,
                   CAST(sum(line_amount) AS DOUBLE) AS revenue_generated
            FROM fact_order_lines JOIN dim_product USING (dim_product_key) JOIN dim_date USING (dim_date_key)
            WHERE full_date >= DATE '{REPORT_DAY[:10]}' - 30
            GROUP BY category_name, brand_name, product_name ORDER BY revenue_generated DESC""",
    ),
)
def v_product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.v_product_performance(
        _fact_order_lines(spark, sf_dir), _dim_product(spark, sf_dir), _dim_date(spark, sf_dir), REPORT_DAY
    )


@query(
    "star_build",
    with_inputs(
        [*_ORDER_INPUTS, "silver_lines", "products", "brands", "categories"],
        f"""{_SNAPSHOT}, {_FACT_LINES.strip().removeprefix(_CUSTOMER.strip()).lstrip(', ' + chr(10))}""",
        """SELECT 'dim_product' AS table_name, count(*) + 1 AS row_count, CAST(NULL AS DOUBLE) AS amount FROM dim_product
           UNION ALL SELECT 'dim_customer', count(*), NULL FROM dim_customer
           UNION ALL SELECT 'dim_location', count(*) + 1, NULL FROM dim_location
           UNION ALL SELECT 'dim_date', CAST(max(o_orderdate) AS DATE) - CAST(min(o_orderdate) AS DATE) + 1, NULL FROM orders
           UNION ALL SELECT 'fact_orders', count(*), CAST(sum(total_amount) AS DOUBLE) FROM fact_orders
           UNION ALL SELECT 'fact_order_lines', count(*), CAST(sum(line_amount) AS DOUBLE) FROM fact_order_lines
           UNION ALL SELECT 'agg_customer_monthly_snapshot', count(*), CAST(sum(lifetime_revenue) AS DOUBLE)
           FROM snapshot""",
    ),
)
def star_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two builds in a row, written and read back; the second one changes nothing but audit columns."""
    silver = {
        "customers": frame(spark, sf_dir, "known_customers"),
        "products": frame(spark, sf_dir, "products"),
        "brands": frame(spark, sf_dir, "brands"),
        "categories": frame(spark, sf_dir, "categories"),
        "addresses": addresses(spark, sf_dir),
        "city_tiers": city_tiers(spark, sf_dir),
        "orders": frame(spark, sf_dir, "silver_orders"),
        "order_lines": frame(spark, sf_dir, "silver_lines"),
    }
    root = fresh_path(spark, "star")
    settings = {
        # A folder per day suits large facts only; here it would mean files of a few rows.
        "partition_by": {"agg_customer_monthly_snapshot": ("month_key",)},
    }
    run_star(silver, root, 1, RUN_1, FIRST_LOAD, **settings)
    built = run_star(silver, root, 2, RUN_3, THIRD_LOAD, **settings)
    amounts = {
        "dim_product": F.lit(None),
        "dim_customer": F.lit(None),
        "dim_location": F.lit(None),
        "dim_date": F.lit(None),
        "fact_orders": F.sum("total_amount"),
        "fact_order_lines": F.sum("line_amount"),
        "agg_customer_monthly_snapshot": F.sum("lifetime_revenue"),
    }
    counts = [
        built[name].agg(F.count(F.lit(1)).alias("row_count"), amount.cast("double").alias("amount")).select(
            F.lit(name).alias("table_name"), "row_count", "amount"
        )
        for name, amount in amounts.items()
    ]
    every = counts[0]
    for more in counts[1:]:
        every = every.unionByName(more)
    return every


# Stamps of a load, which differ between rows of the first and of the second build.
_STAMPS = ("_created_date", "_pipeline_run_id", "_valid_from", "_valid_to")


def _row_columns(name: str) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in STAR_SCHEMA[name].fields if f.name not in _STAMPS]


def _row_sql(name: str, source: str) -> str:
    """A table's rows as text: the declared types as strings, NULL as a mark."""
    parts = [f"coalesce(CAST(CAST({c} AS {kind}) AS VARCHAR), '~')" for c, kind in _row_columns(name)]
    return f"SELECT '{name}' AS table_name, sha256({" || '|' || ".join(parts)}) AS row_hash FROM {source}"


def _row_frame(name: str, df: DataFrame) -> DataFrame:
    parts = [F.coalesce(F.col(c).cast(kind).cast("string"), F.lit("~")) for c, kind in _row_columns(name)]
    return df.select(F.lit(name).alias("table_name"), F.sha2(F.concat_ws("|", *parts), 256).alias("row_hash"))


_UNKNOWN_ROWS = {
    "dim_product": "(SELECT * FROM dim_product UNION ALL SELECT -1, -1, 'UNKNOWN', 'Unknown', NULL, 'Unknown', NULL, "
    "'Unknown', NULL, NULL, NULL, NULL)",
    "dim_location": "(SELECT * FROM dim_location UNION ALL SELECT -1, -1, 'Unknown', 'Unknown', NULL, NULL, NULL, NULL, "
    "NULL, NULL)",
}


@query(
    "star_catalog_rows",
    with_inputs(
        [*_ORDER_INPUTS, "silver_lines", "products", "brands", "categories"],
        f"""{_SNAPSHOT}, {_FACT_LINES.strip().removeprefix(_CUSTOMER.strip()).lstrip(', ' + chr(10))}""",
        " UNION ALL ".join(
            _row_sql(name, _UNKNOWN_ROWS.get(name, "snapshot" if name.startswith("agg_") else name)) for name in STAR_SCHEMA
        ),
    ),
)
def star_catalog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two builds into the catalog, order facts in folders, the second one of the latest orders only; every
    row of every table as the published names give it."""
    silver = {
        "customers": frame(spark, sf_dir, "known_customers"),
        "products": frame(spark, sf_dir, "products"),
        "brands": frame(spark, sf_dir, "brands"),
        "categories": frame(spark, sf_dir, "categories"),
        "addresses": addresses(spark, sf_dir),
        "city_tiers": city_tiers(spark, sf_dir),
        "orders": frame(spark, sf_dir, "silver_orders"),
        "order_lines": frame(spark, sf_dir, "silver_lines"),
    }
    root, database = fresh_path(spark, "star"), f"star_{uuid.uuid4().hex}"
    create_database(spark, database, f"{root}-database")
    # A folder per day suits large facts only; here it would mean thousands of files of a few rows.
    folders = {"fact_orders": ("order_status",), "agg_customer_monthly_snapshot": ("month_key",)}
    run_star(silver, root, 1, RUN_1, THIRD_LOAD, database=database, partition_by=folders)
    latest = silver["orders"].filter(f"order_date >= TIMESTAMP '{LATEST_ORDERS}'")
    lines = silver["order_lines"].join(latest.select("order_number"), "order_number", "left_semi")
    run_star({**silver, "orders": latest, "order_lines": lines}, root, 2, RUN_3, THIRD_LOAD, database=database, partition_by=folders)
    publish_star(spark, database, root, 2)
    every = None
    for name in STAR_SCHEMA:
        rows = _row_frame(name, spark.table(f"{database}.{name}"))
        every = rows if every is None else every.unionByName(rows)
    return every
