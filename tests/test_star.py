import datetime as dt
import glob
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sedimenta.plans import dimensions, facts, snapshots, views
from sedimenta.plans import star as star_plan
from sedimenta.plans.schemas import PARTITIONED_BY, STAR_SCHEMA
from sedimenta.plans.star import publish_star, read_star, register_star, run_star
from sedimenta.sources.tables import date_range, read_snapshot

T1, T2, T3 = "2024-01-31 00:00:00", "2024-02-29 00:00:00", "2024-03-31 00:00:00"
CUSTOMER = (
    "customer_id bigint, email string, first_name string, last_name string, gender string, date_of_birth date, "
    "registration_date timestamp, customer_type string, status string"
)


def customers(spark, *rows):
    return spark.createDataFrame([(i, f"{i}@x.com", "F", "L", "U", None, None, t, s) for i, t, s in rows], CUSTOMER)


def plain(df, *columns):
    return sorted(map(tuple, df.select(*(columns or df.columns)).collect()), key=repr)


def test_dates(spark):
    days = dimensions.dim_date(date_range(spark, "2020-01-01", "2030-12-31"))
    assert days.schema == STAR_SCHEMA["dim_date"] or [f.dataType for f in days.schema] == [
        f.dataType for f in STAR_SCHEMA["dim_date"]
    ]
    assert days.count() == 4018
    row = days.filter("dim_date_key = 20240229").first()
    assert (row.full_date, row.quarter, row.month_name, row.week_of_year) == (dt.date(2024, 2, 29), 1, "February", 9)
    assert (row.day_of_week, row.day_name, row.is_weekend) == (5, "Thursday", False)
    assert days.filter("is_weekend AND day_name NOT IN ('Saturday', 'Sunday')").count() == 0


def test_customer_versions(spark):
    first = dimensions.dim_customer(None, customers(spark, (30, "A", "on"), (10, "A", "on"), (20, "A", None)), "r1", T1)
    columns = ("customer_id", "dim_customer_key", "customer_type", "status", "_version", "_is_current", "rfm_segment")
    assert plain(first, *columns) == sorted(
        [
            (-1, -1, "Standard", "Active", 1, True, "Unknown"),
            (10, 1, "A", "on", 1, True, "New"),
            (20, 2, "A", None, 1, True, "New"),
            (30, 3, "A", "on", 1, True, "New"),
        ],
        key=repr,
    )
    second = dimensions.dim_customer(
        first, customers(spark, (10, "A", "on"), (20, "A", "on"), (30, "B", "on"), (5, "A", "on")), "r2", T2
    )
    third = dimensions.dim_customer(second, customers(spark, (30, None, "on")), "r3", T3)
    assert [f.name for f in third.schema] == STAR_SCHEMA["dim_customer"].names
    got = plain(third.filter("customer_id > 0"), *columns[:-1])
    assert got == sorted(
        [
            (5, 4, "A", "on", 1, True),
            (10, 1, "A", "on", 1, True),
            (20, 2, "A", None, 1, False),
            (20, 5, "A", "on", 2, True),
            (30, 3, "A", "on", 1, False),
            (30, 6, "B", "on", 2, False),
            (30, 7, None, "on", 3, True),
        ],
        key=repr,
    )
    closed = third.filter("customer_id = 30 AND NOT _is_current").select("_version", "_valid_from", "_valid_to")
    assert sorted((v, str(a), str(b)) for v, a, b in closed.collect()) == [(1, T1, T2), (2, T2, T3)]
    same = dimensions.dim_customer(third, customers(spark, (30, None, "on")), "r4", T3)
    assert plain(same, *columns) == plain(third, *columns)


def silver(spark):
    order = (
        "order_number string, customer_id bigint, shipping_address_id bigint, order_date timestamp_ntz, "
        "order_status string, payment_method string, total_amount double, subtotal_amount double, "
        "discount_amount double, tax_amount double, shipping_amount double"
    )
    when = lambda *d: dt.datetime(*d)
    orders = [
        ("A", 1, 100, when(2024, 1, 5), "Delivered", "card", 10.0, 9.0, 1.0, 0.5, 0.5),
        ("B", 1, 999, when(2024, 1, 9), "Shipped", "card", 20.0, 9.0, 1.0, 0.5, 0.5),
        ("C", 7, 100, when(2024, 2, 1), "Shipped", "cash", 40.0, 9.0, 1.0, 0.5, 0.5),
        ("D", 1, 100, when(2024, 2, 2), "Draft", "cash", 80.0, 9.0, 1.0, 0.5, 0.5),
        ("E", None, None, when(2024, 2, 3), None, "cash", 160.0, 9.0, 1.0, 0.5, 0.5),
        ("F", 1, 100, when(2024, 3, 3), "Delivered", "card", 5.0, 9.0, 1.0, 0.5, 0.5),
    ]
    lines = [("A", 1, 50, 2.0, 6.0, 3.0), ("A", 2, 51, 1.0, 4.0, 4.0), ("F", 1, 99, 1.0, 5.0, 5.0), ("?", 1, 50, 1.0, 1.0, 1.0)]
    return {
        "customers": customers(spark, (1, "A", "on"), (2, "A", "on")),
        "products": spark.createDataFrame(
            [(50, "s50", "Cup", 3.0, 1, 1), (51, "s51", "Mug", 4.0, 9, None)],
            "product_id bigint, sku string, item_name string, list_price double, brand_id int, category_id int",
        ),
        "brands": spark.createDataFrame([(1, "Acme", "Top")], "brand_id int, brand_name string, brand_tier string"),
        "categories": spark.createDataFrame([(1, "Kitchen")], "category_id int, category_name string"),
        "addresses": spark.createDataFrame(
            [(100, "Here", "S", "1"), (101, "There", "S", "2")], "address_id bigint, city string, state string, pincode string"
        ),
        "city_tiers": spark.createDataFrame(
            [("Here", "S", 1, True, "N")], "city string, state string, city_tier int, is_metro boolean, region string"
        ),
        "orders": spark.createDataFrame(orders, order),
        "order_lines": spark.createDataFrame(
            lines,
            "order_number string, line_number int, product_id bigint, quantity double, line_amount double, unit_price double",
        ),
    }


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("star"))
    tables = run_star(silver(spark), root, 1, "r1", T3)
    return root, tables


def test_declared_schemas(star):
    for name, df in star[1].items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in STAR_SCHEMA[name]], name


def test_dimensions(star):
    tables = star[1]
    assert plain(tables["dim_product"], "dim_product_key", "product_name", "list_price", "brand_name", "category_name") == [
        (-1, "Unknown", None, "Unknown", "Unknown"),
        (50, "Cup", Decimal("3.00"), "Acme", "Kitchen"),
        (51, "Mug", Decimal("4.00"), None, None),
    ]
    assert plain(tables["dim_location"], "dim_location_key", "city_tier", "is_metro", "region") == [
        (-1, None, None, None),
        (100, 1, True, "N"),
        (101, None, None, None),
    ]


def test_facts(star):
    tables = star[1]
    assert plain(
        tables["fact_orders"], "order_number", "dim_date_key", "dim_customer_key", "dim_location_key", "is_delivered"
    ) == [
        ("A", 20240105, 1, 100, 1),
        ("B", 20240109, 1, -1, 0),
        ("C", 20240201, -1, 100, 0),
        ("F", 20240303, 1, 100, 1),
    ]
    assert plain(tables["fact_order_lines"], "order_number", "line_number", "dim_product_key", "quantity", "line_status") == [
        ("A", 1, 50, 2, "Closed"),
        ("A", 2, 51, 1, "Closed"),
        ("F", 1, -1, 1, "Closed"),
    ]


def test_snapshot(star):
    snapshot = star[1]["agg_customer_monthly_snapshot"]
    assert plain(
        snapshot, "dim_customer_key", "month_key", "monthly_orders", "lifetime_revenue", "recency_days", "aov_lifetime"
    ) == [
        (-1, 202402, 1, Decimal("40.00"), 59, Decimal("40.00")),
        (1, 202401, 2, Decimal("30.00"), 82, Decimal("15.00")),
        (1, 202403, 3 - 2, Decimal("35.00"), 28, Decimal("11.67")),
    ]
    orders, days = star[1]["fact_orders"], star[1]["dim_date"]
    assert plain(snapshots.customer_monthly_base(orders, days, unique_orders=True)) == plain(
        snapshots.customer_monthly_base(orders, days)
    )
    assert plain(views.v_monthly_sales_trend(orders, days, unique_orders=True)) == plain(
        views.v_monthly_sales_trend(orders, days)
    )


def test_views(spark, star):
    made = views.register_views(star[1], T3)
    assert set(made) == {"v_customer_360", "v_monthly_sales_trend", "v_product_performance"}
    assert [tuple(r)[:6] for r in spark.table("v_customer_360").collect()] == [(1, "F", "L", "A", "New", 202403)]
    trend = spark.table("v_monthly_sales_trend").collect()
    assert [(r.year, r.month_number, r.total_revenue, r.total_orders) for r in trend] == [
        (2024, 3, Decimal("5.00"), 1),
        (2024, 2, Decimal("40.00"), 1),
        (2024, 1, Decimal("30.00"), 2),
    ]
    # Product 99 is unknown, and reported as such; the other sales are older than thirty days.
    assert [tuple(r) for r in spark.table("v_product_performance").collect()] == [
        ("Unknown", "Unknown", "Unknown", 1, Decimal("5.00"))
    ]
    earlier = views.v_product_performance(
        star[1]["fact_order_lines"], star[1]["dim_product"], star[1]["dim_date"], "2024-01-20 00:00:00"
    )
    assert [tuple(r) for r in earlier.collect()] == [
        ("Kitchen", "Acme", "Cup", 2, Decimal("6.00")),
        ("Unknown", "Unknown", "Unknown", 1, Decimal("5.00")),
        (None, None, "Mug", 1, Decimal("4.00")),
    ]


def test_second_build(spark, star):
    root, before = star
    later = silver(spark)
    later["customers"] = customers(spark, (1, "B", "on"), (3, "A", "on"))
    later["products"] = later["products"].filter("product_id = 50").withColumn("sku", later["products"]["item_name"])
    tables = run_star(later, root, 2, "r2", "2024-04-30 00:00:00")
    assert plain(tables["dim_customer"].filter("_is_current"), "customer_id", "dim_customer_key", "_version") == sorted(
        [(-1, -1, 1), (1, 3, 2), (2, 2, 1), (3, 4, 1)], key=repr
    )
    assert plain(tables["dim_product"], "product_id", "sku", "_created_date", "_pipeline_run_id") == [
        (-1, "UNKNOWN", None, None),
        (50, "Cup", dt.datetime(2024, 3, 31), "r2"),
        (51, "s51", dt.datetime(2024, 3, 31), "r1"),
    ]
    assert plain(tables["fact_orders"], "order_number", "dim_customer_key", "_pipeline_run_id") == [
        ("A", 3, "r2"),
        ("B", 3, "r2"),
        ("C", -1, "r2"),
        ("F", 3, "r2"),
    ]
    # The version before is still there.
    assert plain(read_star(spark, root, "fact_orders", 1)) == plain(before["fact_orders"])

    register_star(spark, "gold_tables", root, 2)
    for name in STAR_SCHEMA:
        stored = spark.table(f"gold_tables.{name}")
        assert plain(stored.select(*STAR_SCHEMA[name].names)) == plain(tables[name]), name
    publish_star(spark, "gold", root, 1)
    assert spark.table("gold.dim_customer").filter("_is_current").count() == 3
    publish_star(spark, "gold", root, 2)
    assert spark.table("gold.dim_customer").filter("_is_current").count() == 4
    views.publish_views(spark, "gold", "DATE'2024-01-20'")
    frames = {
        "v_customer_360": views.v_customer_360(tables["dim_customer"], tables["agg_customer_monthly_snapshot"]),
        "v_monthly_sales_trend": views.v_monthly_sales_trend(tables["fact_orders"], tables["dim_date"]),
        "v_product_performance": views.v_product_performance(
            tables["fact_order_lines"], tables["dim_product"], tables["dim_date"], "2024-01-20 00:00:00"
        ),
    }
    for name, frame in frames.items():
        assert plain(spark.table(f"gold.{name}")) == plain(frame), name
    assert set(PARTITIONED_BY) < set(STAR_SCHEMA)


def test_builds_into_a_database_rewrite_only_what_they_touch(spark, tmp_path):
    root = str(tmp_path)
    plainly = str(tmp_path / "plain")
    first = run_star(silver(spark), root, 1, "r1", T3, database="star_db")
    run_star(silver(spark), plainly, 1, "r1", T3)
    later = silver(spark)
    later["orders"] = later["orders"].filter("order_number = 'B'")
    later["order_lines"] = later["order_lines"].filter("order_number = 'B'")
    day = later["orders"].selectExpr("CAST(date_format(order_date, 'yyyyMMdd') AS INT) AS d").first().d
    before = {f: open(f, "rb").read() for f in glob.glob(f"{root}/fact_orders/version=0000000001/*/*.parquet")}
    second = run_star(later, root, 2, "r2", T3, database="star_db")
    same = run_star(later, plainly, 2, "r2", T3)
    for name in STAR_SCHEMA:
        assert plain(second[name].select(*STAR_SCHEMA[name].names)) == plain(same[name].select(*STAR_SCHEMA[name].names)), name
    assert {f: open(f, "rb").read() for f in before} == before
    written = {p.split("=")[-1] for p in glob.glob(f"{root}/fact_orders/version=0000000002/dim_date_key=*")}
    assert written == {str(day)}
    assert first["fact_orders"].count() == second["fact_orders"].count()


def test_published_facts_are_whole_after_a_build_of_few_partitions(spark, tmp_path):
    root = str(tmp_path)
    run_star(silver(spark), root, 1, "r1", T3, database="whole_db")
    later = {**silver(spark)}
    later["orders"] = later["orders"].filter("order_number = 'B'")
    later["order_lines"] = later["order_lines"].filter("order_number = 'B'")
    second = run_star(later, root, 2, "r2", T3, database="whole_db")
    first = {name: plain(read_star(spark, root, name, 1)) for name in STAR_SCHEMA}
    for name in ("fact_orders", "fact_order_lines"):
        assert plain(spark.table(f"whole_db.{name}"), *STAR_SCHEMA[name].names) == plain(second[name])
        assert second[name].count() >= 1 and len(first[name]) >= second[name].count()
    register_star(spark, "whole_tables", root, 2)
    for version, wanted in ((1, first), (2, {n: plain(second[n]) for n in STAR_SCHEMA})):
        publish_star(spark, "whole_views", root, version)
        for name in STAR_SCHEMA:
            assert plain(spark.table(f"whole_views.{name}"), *STAR_SCHEMA[name].names) == wanted[name], name
    for name in STAR_SCHEMA:
        assert plain(spark.table(f"whole_tables.{name}"), *STAR_SCHEMA[name].names) == plain(second[name]), name
    # A further build without the catalog goes on from all rows.
    third = run_star(later, root, 3, "r3", T3)
    assert third["fact_orders"].count() == second["fact_orders"].count()


@pytest.mark.parametrize("partition_by", [PARTITIONED_BY, {}])
def test_orders_without_a_date_do_not_stop_a_build(spark, tmp_path, partition_by):
    root, tables = str(tmp_path), silver(spark)
    undated = F.when(F.col("order_number") == "A", None).otherwise(F.col("order_date"))
    tables["orders"] = tables["orders"].withColumn("order_date", undated)
    first = run_star(tables, root, 1, "r1", T3, partition_by=partition_by)
    missing = "dim_date_key IS NULL"
    assert {r.order_number for r in first["fact_orders"].filter(missing).collect()} == {"A"}
    lines = first["fact_order_lines"].filter(missing).count()
    assert lines == tables["order_lines"].filter("order_number = 'A'").count() > 0
    # Another order comes: what has no date stays.
    later = {**tables, "orders": tables["orders"].filter("order_number = 'F'"), "order_lines": tables["order_lines"].filter("order_number = 'F'")}
    second = run_star(later, root, 2, "r2", T3, partition_by=partition_by)
    assert second["fact_orders"].count() == first["fact_orders"].count()
    assert second["fact_order_lines"].filter(missing).count() == lines
    # The order gets its date: it and its lines move.
    dated = {**silver(spark)}
    third = run_star(dated, root, 3, "r3", T3, partition_by=partition_by)
    assert third["fact_orders"].filter(missing).count() == 0 and third["fact_order_lines"].filter(missing).count() == 0
    assert third["fact_order_lines"].count() == first["fact_order_lines"].count()


@pytest.mark.parametrize("partition_by", [PARTITIONED_BY, {}])
def test_facts_of_late_dimension_rows_get_their_keys(spark, tmp_path, partition_by):
    root, tables = str(tmp_path), silver(spark)
    known = dict(tables)
    known["customers"] = known["customers"].filter("customer_id <> 1")
    known["products"] = known["products"].filter("product_id <> 50")
    first = run_star(known, root, 1, "r1", T3, partition_by=partition_by)
    unknown = first["fact_orders"].filter("dim_customer_key = -1").count()
    assert unknown > 1 and first["fact_order_lines"].filter("dim_product_key = -1").count() > 0
    # The rows arrive with a batch of one order: all facts that waited for them get the keys.
    batch = {**tables, "orders": tables["orders"].filter("order_number = 'F'"), "order_lines": tables["order_lines"].filter("order_number = 'F'")}
    second = run_star(batch, root, 2, "r2", T3, partition_by=partition_by)
    keys = {r.customer_id: r.dim_customer_key for r in second["dim_customer"].filter("_is_current").collect()}
    of_order = {r.order_number: r.customer_id for r in tables["orders"].collect()}
    for r in second["fact_orders"].collect():
        assert r.dim_customer_key == keys.get(of_order[r.order_number], -1), r.order_number
    for r in second["fact_order_lines"].collect():
        assert r.dim_customer_key == keys.get(of_order[r.order_number], -1)
    assert second["fact_order_lines"].filter("order_number = 'A' AND line_number = 1").first().dim_product_key != -1
    assert second["fact_orders"].count() == first["fact_orders"].count()
    assert second["fact_order_lines"].count() == first["fact_order_lines"].count()


@pytest.mark.parametrize("partition_by", [PARTITIONED_BY, {}])
def test_builds_join_no_source_again_and_count_orders_plainly(spark, tmp_path, monkeypatch, partition_by):
    sources, counted = [], []
    listed, count = star_plan.open_references, snapshots.order_count
    monkeypatch.setattr(star_plan, "open_references", lambda f, s, *a: sources.append(s) or listed(f, s, *a))
    monkeypatch.setattr(snapshots, "order_count", lambda unique: counted.append(unique) or count(unique))
    for version in (1, 2):
        built = run_star(silver(spark), str(tmp_path), version, f"r{version}", T3, partition_by=partition_by)
        for name in ("fact_orders", "fact_order_lines"):
            assert built[name].columns == STAR_SCHEMA[name].names
            kept = read_snapshot(spark, f"{tmp_path}/open_{name}", version)
            assert kept.columns[-2:] == ["reference", "wanted"]
    assert [s is None for s in sources] == [False, True] * 2 and counted and all(counted)


def test_a_build_that_failed_is_run_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path)

    def fails(*_, **__):
        raise OSError("no catalog")

    run_star(silver(spark), root, 1, "r1", T3, database="again_db")
    with monkeypatch.context() as broken:
        broken.setattr("sedimenta.plans.star.publish", fails)
        with pytest.raises(OSError):
            run_star(silver(spark), root, 2, "r2", T3, database="again_db")
    half = {name: plain(read_star(spark, root, name, 2)) for name in ("dim_customer", "fact_orders", "fact_order_lines")}
    again = run_star(silver(spark), root, 2, "r2", T3, database="again_db")
    for name, rows in half.items():  # what was complete stays as it is
        assert plain(again[name]) == rows, name
    assert plain(spark.table("again_db.fact_orders"), *STAR_SCHEMA["fact_orders"].names) == half["fact_orders"]
    assert again["agg_customer_monthly_snapshot"].count() > 0


def test_days_are_those_of_the_orders(star):
    days = star[1]["dim_date"].selectExpr("min(full_date) AS a", "max(full_date) AS b", "count(*) AS n").first()
    assert (days.b - days.a).days + 1 == days.n
    assert star[1]["fact_orders"].join(star[1]["dim_date"], "dim_date_key", "left_anti").count() == 0


def test_amounts_that_do_not_fit_stop_the_build(spark, tmp_path):
    tables = silver(spark)
    tables["orders"] = tables["orders"].withColumn("total_amount", F.lit("1e20").cast("double"))
    with pytest.raises(Exception, match="no decimal"):
        run_star(tables, str(tmp_path), 1, "r1", T3)


def test_lines_outside_the_replaced_range_fail(spark, tmp_path):
    with pytest.raises(Exception, match="does not satisfy"):
        run_star(silver(spark), str(tmp_path), 1, "r1", T3, lines_from=20240201)


def test_order_upsert(spark):
    old = spark.createDataFrame([("A", 1), ("B", 2)], "order_number string, n int")
    new = spark.createDataFrame([("B", 3), ("C", 4)], "order_number string, n int")
    assert plain(facts.upsert_orders(old, new)) == [("A", 1), ("B", 3), ("C", 4)]
