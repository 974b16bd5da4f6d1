"""Compares ways of writing the operators that decide the cost of a load.

``python benchmarks/forms.py [copies]`` enlarges the sf0.1 tables (each copy with
its own keys) into a scratch folder, runs every form on the same files and prints
median seconds and shuffled megabytes.
"""

from __future__ import annotations

import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from sedimenta.config import NULL_CHECK, RANGE_CHECK, Rule  # noqa: E402
from sedimenta.functions.columns import date_key  # noqa: E402
from sedimenta.operators.changes import latest_per_key  # noqa: E402
from sedimenta.operators.history import (  # noqa: E402
    scd2_apply,
    scd2_changed_keys,
    scd2_expired_rows,
    scd2_initial,
    scd2_new_rows,
)
from sedimenta.operators.keys import with_surrogate_key  # noqa: E402
from sedimenta.operators.merge import upsert  # noqa: E402
from sedimenta.operators.quality import rejected_rows, tag_rows, valid_rows  # noqa: E402
from sedimenta.plans.dimensions import dim_date  # noqa: E402
from sedimenta.plans.snapshots import customer_monthly_snapshot  # noqa: E402
from sedimenta.plans.views import v_monthly_sales_trend, v_product_performance  # noqa: E402
from sedimenta.sources.tables import date_range  # noqa: E402
from tests.sessions import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
KEYS, TRACKED, NOW = ["o_orderkey"], ["o_orderstatus", "o_orderpriority"], "2024-01-01 00:00:00"


def enlarged(spark, copies: int, folder: str) -> dict[str, str]:
    paths = {}
    keys = {"orders": ["o_orderkey", "o_custkey"], "lineitem": ["l_orderkey"]}
    for name, shifted in keys.items():
        df = spark.read.parquet(f"{SF_DIR}/{name}.parquet").withColumn(
            "copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
        )
        for key in shifted:
            df = df.withColumn(key, F.col(key) + F.col("copy") * F.lit(1_000_000))
        paths[name] = f"{folder}/{name}"
        df.drop("copy").repartition(16).write.parquet(paths[name])
    return paths


def shuffled_mb(spark) -> float:
    gateway = spark.sparkContext._gateway
    none = gateway.jvm.java.util.ArrayList()
    quantiles = gateway.new_array(gateway.jvm.double, 0)
    stages = spark._jsc.sc().statusStore().stageList(none, False, False, quantiles, none)
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size())) / 1e6


def measure(spark, label: str, form, runs: int = 3) -> None:
    def once() -> float:
        start = time.perf_counter()
        for df in form():
            df.write.format("noop").mode("overwrite").save()
        spark.catalog.clearCache()
        return time.perf_counter() - start

    once()
    before = shuffled_mb(spark)
    seconds = statistics.median(once() for _ in range(runs))
    print(f"{label:58s} {seconds:7.2f} s {(shuffled_mb(spark) - before) / runs:9.1f} MB", flush=True)


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 20
    wanted = set(sys.argv[2:])
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    paths = enlarged(spark, copies, folder)
    orders, lines = (spark.read.parquet(paths[n]) for n in ("orders", "lineitem"))
    print(f"orders {orders.count()}, lines {lines.count()}", flush=True)

    def section(name: str) -> bool:
        return not wanted or name in wanted

    if section("keys"):
        measure(spark, "keys: one global window", lambda: [
            orders.withColumn("sk", F.row_number().over(Window.orderBy("o_orderkey")))])
        measure(spark, "keys: range partitions and offsets (chosen)", lambda: [
            with_surrogate_key(orders, ["o_orderkey"], "sk")])

    # A batch of changes to about a tenth of the rows.
    batch = orders.filter(F.col("o_orderdate") >= "2001-01-01").withColumn("o_totalprice", F.col("o_totalprice") + 1)

    if section("merge"):
        def full_outer():
            t, s = orders.alias("t"), batch.alias("s")
            hit = F.col("s.o_orderkey").isNotNull()
            return [t.join(s, F.col("t.o_orderkey") == F.col("s.o_orderkey"), "full").select(
                *[F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in orders.columns])]

        measure(spark, "merge: full outer join", full_outer)
        measure(spark, "merge: anti join and union (chosen)", lambda: [upsert(orders, batch, KEYS)])

    if section("latest"):
        changes = lines.select(F.col("l_partkey").alias("k"), F.monotonically_increasing_id().alias("p"),
                               "l_extendedprice", "l_shipdate", "l_quantity")
        measure(spark, "latest per key: max_by of a struct", lambda: [
            changes.groupBy("k").agg(F.max_by(F.struct(*changes.columns), "p").alias("r")).select("r.*")])
        measure(spark, "latest per key: row_number = 1 (chosen)", lambda: [latest_per_key(changes, ["k"], ["p"])])

    if section("history"):
        state = f"{folder}/state"
        scd2_initial(orders, TRACKED, "2020-01-01 00:00:00").write.parquet(state)
        target = spark.read.parquet(state)
        source = orders.withColumn("o_orderpriority", F.when(
            F.col("o_orderdate") >= "2000-06-01", F.lit("0-NEW")).otherwise(F.col("o_orderpriority")))

        def separate(s):
            changed = scd2_changed_keys(target, s, KEYS, TRACKED)
            expired = scd2_expired_rows(target, s, KEYS, TRACKED, NOW)
            rest = target.join(changed, KEYS, "left_anti").select(*target.columns)
            versions = scd2_initial(s.join(changed, KEYS, "left_semi"), TRACKED, NOW)
            return [rest.unionByName(expired).unionByName(versions).unionByName(
                scd2_new_rows(target, s, KEYS, TRACKED, NOW))]

        # Stored, as a load stages its batch: Spark judges a side by the size of its files.
        source.write.parquet(f"{folder}/whole")
        source.filter("o_orderdate >= '2001-07-01'").write.parquet(f"{folder}/small")
        for label, name in (("whole source", "whole"), ("small batch", "small")):
            s = spark.read.parquet(f"{folder}/{name}")
            measure(spark, f"history, {label}: separate expire and insert", lambda s=s: separate(s))
            measure(spark, f"history, {label}: one full join (default)", lambda s=s: [
                scd2_apply(target, s, KEYS, TRACKED, NOW)])
            measure(spark, f"history, {label}: left and semi joins (small_source)", lambda s=s: [
                scd2_apply(target, s, KEYS, TRACKED, NOW, small_source=True)])

    if section("quality"):
        rules = [Rule("A", RANGE_CHECK, "o_totalprice", "o_totalprice > 1000"),
                 Rule("B", NULL_CHECK, "o_orderpriority", "o_orderpriority IS NOT NULL")]

        def persisted():
            tagged = tag_rows(orders, rules).persist()
            return [tagged.filter("_accepted"), tagged.filter("NOT _accepted")]

        measure(spark, "quality, both outputs: tagged once and persisted", persisted)
        measure(spark, "quality, both outputs: two filters (chosen)", lambda: [
            valid_rows(orders, rules), rejected_rows(orders, rules)])

    fact = orders.select(
        date_key("o_orderdate").alias("dim_date_key"), F.col("o_custkey").alias("dim_customer_key"),
        F.col("o_orderkey").cast("string").alias("order_number"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total_amount"),
        F.lit(0).cast("decimal(18,2)").alias("discount_amount"))
    days = dim_date(date_range(spark, "1995-01-01", "2001-12-31"))

    if section("snapshot"):
        for unique in (False, True):
            form = "order numbers known unique" if unique else "exact distinct (default)"
            measure(spark, f"snapshot: {form}", lambda u=unique: [
                customer_monthly_snapshot(fact, days, "r", NOW, unique_orders=u)])
        measure(spark, "snapshot: facts first partitioned by customer", lambda: [
            customer_monthly_snapshot(fact.repartition("dim_customer_key"), days, "r", NOW)])

    if section("views"):
        for unique in (False, True):
            form = "order numbers known unique" if unique else "exact distinct (default)"
            measure(spark, f"sales trend: {form}", lambda u=unique: [v_monthly_sales_trend(fact, days, u)])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        measure(spark, "sales trend: no broadcast of the dates", lambda: [v_monthly_sales_trend(fact, days)])
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        sold = lines.select(
            date_key("l_shipdate").alias("dim_date_key"), F.col("l_partkey").alias("dim_product_key"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("line_amount"))
        products = spark.read.parquet(f"{SF_DIR}/part.parquet").selectExpr(
            "p_partkey AS dim_product_key", "p_type AS category_name", "p_brand AS brand_name", "p_name AS product_name")

        def join_first():
            return [sold.join(products, "dim_product_key").join(
                days.filter(F.col("full_date") >= "1995-01-01").select("dim_date_key"), "dim_date_key").groupBy(
                "category_name", "brand_name", "product_name").agg(F.sum("quantity"), F.sum("line_amount"))]

        measure(spark, "products, all days: join names, then sum", join_first)
        measure(spark, "products, all days: sum by key, then names (chosen)", lambda: [
            v_product_performance(sold, products, days, "1995-01-31 00:00:00")])
    spark.stop()


if __name__ == "__main__":
    main()
