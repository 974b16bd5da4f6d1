"""One key may hold a third of all rows: what the plans do about it."""

import contextlib
import re

import pytest
from pyspark.sql import functions as F

from sedimenta.operators.changes import apply_changes, latest_per_key
from sedimenta.operators.history import scd2_apply, scd2_initial
from sedimenta.operators.keys import lookup_key, with_surrogate_key
from sedimenta.operators.merge import upsert, upsert_keeping
from sedimenta.operators.quality import orphan_rows, table_rules, with_parent_flag
from sedimenta.plans.bronze import initial_load
from sedimenta.plans.facts import fact_orders
from sedimenta.plans.snapshots import customer_monthly_base
from sedimenta.plans.views import v_monthly_sales_trend, v_product_performance

ROWS = 60_000


@contextlib.contextmanager
def settings(spark, **pairs):
    pairs = {k.replace("__", "."): v for k, v in pairs.items()}
    before = {k: spark.conf.get(k, None) for k in pairs}
    for k, v in pairs.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def small_thresholds(spark):
    """Cluster-sized skew in miniature: no broadcast, kilobytes instead of megabytes."""
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__shuffle__partitions="16",
    )


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows point at customer 7, a tenth at none."""
    return spark.range(0, ROWS, 1, 12).selectExpr(
        "id",
        "CASE WHEN id % 3 = 0 THEN 7L WHEN id % 10 = 1 THEN NULL ELSE pmod(xxhash64(id), 5000) END AS customer_id",
        "sha2(CAST(id AS STRING), 256) AS payload",
    )


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.range(0, 4000, 1, 4).selectExpr("id AS customer_id", "id + 100 AS sk", "sha2(CAST(id AS STRING), 256) AS name")


def test_lookup_splits_a_hot_key(spark, facts, dimension):
    with small_thresholds(spark):
        df = lookup_key(facts, dimension, "customer_id", "customer_id", "sk")
        assert "skew=true" in final_plan(df)
        assert df.count() == ROWS
        assert df.filter("customer_id = 7").agg(F.min("sk"), F.max("sk")).first() == (107, 107)
        assert df.filter("customer_id IS NULL AND sk <> -1").count() == 0


def test_reference_checks_split_a_hot_key(spark, facts, dimension, tmp_path):
    # From files and with repeated keys, so that the distinct step is a real one.
    dimension.unionByName(dimension).write.parquet(str(tmp_path / "parents"))
    parents = spark.read.parquet(str(tmp_path / "parents"))
    with small_thresholds(spark):
        flagged = with_parent_flag(facts, "customer_id", parents, "customer_id", "known")
        plan = final_plan(flagged)
        assert "skew=true" in plan and "HashAggregate" in plan
        assert flagged.count() == ROWS
        orphans = orphan_rows(facts, "customer_id", parents, "customer_id", "R")
        assert "skew=true" in final_plan(orphans)
        assert orphans.count() == flagged.filter("NOT known").count()
        narrower = facts.withColumn("customer_id", F.col("customer_id").cast("int"))
        same = with_parent_flag(narrower, "customer_id", parents, "customer_id", "known")
        assert same.filter("known").count() == flagged.filter("known").count()


def test_merges_keep_null_keys_out_of_the_join(spark, facts, tmp_path):
    facts.selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE id END AS id", "payload").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    written = spark.range(0, 30000, 1, 4).selectExpr("id", "'new' AS payload")
    for df in (upsert(target, written, ["id"]), upsert_keeping(target, written, ["id"], [], {})):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [IsNotNull(id)]" in plan and "PushedFilters: [IsNull(id)]" in plan
        assert df.filter("payload = 'new'").count() == 30000
        assert df.filter("id IS NULL").count() == ROWS // 3


def test_history_keeps_null_keys_out_of_the_join(spark, facts, tmp_path):
    rows = facts.selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE id END AS id", "payload")
    scd2_initial(rows, ["payload"], "2024-01-01 00:00:00").write.parquet(str(tmp_path / "state"))
    rows.write.parquet(str(tmp_path / "source"))
    state, source = (spark.read.parquet(str(tmp_path / name)) for name in ("state", "source"))
    df = scd2_apply(state, source, ["id"], ["payload"], "2024-01-02 00:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    # Both join sides read rows with a key only; the rest is read past the join.
    assert plan.count("PushedFilters: [IsNotNull(_is_current), EqualTo(_is_current,true), IsNotNull(id)]") == 1
    assert plan.count("PushedFilters: [IsNotNull(id)]") == 1
    assert plan.count("PushedFilters: [IsNull(id)]") == 1
    # A NULL key matches nothing: the rows of both loads are kept.
    assert df.count() == ROWS + ROWS // 3


def test_latest_per_key_is_reduced_before_the_shuffle(spark, facts):
    plan = latest_per_key(facts, ["customer_id"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit.*Final[\s\S]*Exchange hashpartitioning[\s\S]*WindowGroupLimit.*Partial", plan)


def test_changes_of_a_hot_key(spark, facts):
    changes = facts.dropna().selectExpr(
        "customer_id", "payload", "CASE WHEN id % 5 = 0 THEN 1 ELSE 4 END AS _cdc_operation_code",
        "id AS _cdc_version", "id AS _cdc_seq",
    )
    target = initial_load(changes.select("customer_id", "payload").limit(0), "r", "2024-01-01 00:00:00")
    df = apply_changes(target, changes, ["customer_id"], "r", "2024-01-01 00:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    last = changes.groupBy("customer_id").agg(F.max_by("_cdc_operation_code", "_cdc_version").alias("op"))
    assert df.count() == last.filter("op <> 1").count()


def test_numbering_fills_partitions_evenly(spark, facts):
    keyed = with_surrogate_key(facts, ["customer_id", "id"], "sk", partitions=12)
    sizes = [r["count"] for r in keyed.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3 * ROWS / len(sizes)
    assert keyed.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk")).first() == (1, ROWS, ROWS)
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    # The only single-partition step works on one row per partition.
    assert plan.count("SinglePartition") == 1 and "BroadcastHashJoin" in plan


def test_sums_and_distinct_counts_combine_before_the_shuffle(spark):
    orders = spark.range(0, ROWS, 1, 12).selectExpr(
        "CAST(20240101 + id % 28 AS INT) AS dim_date_key",
        "CASE WHEN id % 3 = 0 THEN 7L ELSE 1000 + id % 1000 END AS dim_customer_key",
        "CAST(id DIV 2 AS STRING) AS order_number",
        "CAST(1 AS DECIMAL(18,2)) AS total_amount",
        "CAST(0 AS DECIMAL(18,2)) AS discount_amount",
    )
    days = spark.range(28).selectExpr(
        "CAST(20240101 + id AS INT) AS dim_date_key", "date_add(DATE '2024-01-01', CAST(id AS INT)) AS full_date",
        "2024 AS year", "'January' AS month_name", "1 AS month_number",
    )
    for df in (customer_monthly_base(orders, days), v_monthly_sales_trend(orders, days)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        exchanges = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
        # The first shuffle spreads by order number; only combined rows meet on the group key.
        assert any("order_number" in e for e in exchanges)
        assert "partial_sum" in plan
    assert customer_monthly_base(orders, days).filter("dim_customer_key = 7").first()["monthly_orders"] == ROWS // 3

    whole = v_monthly_sales_trend(orders, days, unique_orders=True)
    assert "order_number" not in " ".join(
        re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", whole._jdf.queryExecution().executedPlan().toString())
    )


def test_table_rules_count_per_key_first(spark, facts):
    plan = table_rules(facts, ["customer_id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_product_view_filters_the_fact_scan(spark, tmp_path):
    lines = spark.range(0, 1000).selectExpr(
        "CAST(20240101 + id % 28 AS INT) AS dim_date_key", "id % 10 AS dim_product_key", "1 AS quantity",
        "CAST(1 AS DECIMAL(18,2)) AS line_amount",
    )
    lines.write.partitionBy("dim_date_key").parquet(str(tmp_path / "lines"))
    days = spark.range(28).selectExpr(
        "CAST(20240101 + id AS INT) AS dim_date_key", "date_add(DATE '2024-01-01', CAST(id AS INT)) AS full_date"
    )
    products = spark.range(10).selectExpr("id AS dim_product_key", "'c' AS category_name", "'b' AS brand_name", "'p' AS product_name")
    view = v_product_performance(spark.read.parquet(str(tmp_path / "lines")), products, days, "2024-02-20 00:00:00")
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*dim_date_key#\d+ >= 20240121", plan)
    assert view.first()["units_sold"] == 1000 - sum(1 for i in range(1000) if i % 28 < 20)


def test_order_facts_split_hot_customers_and_addresses(spark, tmp_path):
    spark.range(0, ROWS, 1, 12).selectExpr(
        "'ORD-' || id AS order_number",
        "CASE WHEN id % 3 = 0 THEN 7L ELSE pmod(xxhash64(id), 5000) END AS customer_id",
        "CASE WHEN id % 3 = 1 THEN NULL ELSE pmod(xxhash64(id, 1), 5000) END AS shipping_address_id",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS order_date", "'Shipped' AS order_status", "'card' AS payment_method",
        *[f"CAST(id AS DOUBLE) AS {c}_amount" for c in ("total", "subtotal", "discount", "tax", "shipping")],
    ).write.parquet(str(tmp_path / "orders"))
    spark.range(0, 4000, 1, 4).selectExpr("id AS customer_id", "id + 1 AS dim_customer_key", "true AS _is_current").write.parquet(
        str(tmp_path / "customers")
    )
    spark.range(0, 4000, 1, 4).selectExpr("id AS address_id", "id + 1 AS dim_location_key").write.parquet(
        str(tmp_path / "locations")
    )
    orders, customers, locations = (
        spark.read.parquet(str(tmp_path / n)) for n in ("orders", "customers", "locations")
    )
    with small_thresholds(spark), settings(spark, spark__sql__files__maxPartitionBytes="400k"):
        df = fact_orders(orders, customers, locations, "r", "2024-02-01 00:00:00")
        assert final_plan(df).split("== Initial Plan ==")[0].count("skew=true") == 2
        assert df.count() == ROWS
        assert df.filter("dim_customer_key = 8").count() >= ROWS // 3
        assert df.filter("dim_location_key = -1").count() >= ROWS // 3
