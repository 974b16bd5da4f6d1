import glob
import json

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from sedimenta.config import ERROR, NULL_CHECK, RANGE_CHECK, RawConfig, Rule, TableConfig
from sedimenta.operators.merge import upsert, upsert_touched
from sedimenta.plans.bronze import run_incremental_load, run_initial_load, run_raw_load
from sedimenta.plans.schemas import DIM_PRODUCT
from sedimenta.plans.silver import run_reference_audit, run_silver, silver_transform
from sedimenta.sinks.layout import clustered
from sedimenta.sinks.tables import (
    append_rows,
    create_database,
    publish,
    register_table,
    upsert_into_partitions,
    write_bucketed,
    write_quarantine,
    write_replacing,
    write_snapshot,
    write_staging,
)
from sedimenta.sources.tables import quarantine_summary, read_path, read_snapshot, snapshot_path

DAY = "2024-01-01 00:00:00"


def plain(df, *columns):
    return sorted(map(tuple, df.select(*(columns or df.columns)).collect()), key=repr)


def test_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    two = spark.createDataFrame([(1, "a", 5)], "k int, v string, n int")
    write_snapshot(one, root, 1)
    write_snapshot(two, root, 2)
    assert plain(read_snapshot(spark, root, 1)) == [(1, "a")]
    assert plain(read_snapshot(spark, root, 2)) == [(1, "a", 5)]
    with pytest.raises(AnalysisException):
        write_snapshot(one, root, 2)


def test_next_version_may_read_the_one_before(spark, tmp_path):
    root = str(tmp_path / "t")
    write_snapshot(spark.createDataFrame([(20190101, "a"), (20210101, "b")], "d int, v string"), root, 1, ["d"])
    new = spark.createDataFrame([(20220101, "c")], "d int, v string")
    assert plain(write_replacing(new, root, 2, "d >= 20200101", ["d"])) == [(20190101, "a"), (20220101, "c")]
    first = write_replacing(new, str(tmp_path / "u"), 1, "d >= 20200101")
    assert plain(first) == [(20220101, "c")]


def test_partition_values_keep_their_type_and_hot_value_is_split(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.range(0, 40000, 1, 8).selectExpr(
        "id", "CASE WHEN id < 14000 THEN '007' ELSE CAST(id DIV 4000 AS STRING) END AS p", "sha2(CAST(id AS STRING), 256) AS v"
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        back = write_snapshot(df, root, 1, ["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert back.schema["p"].dataType.simpleString() == "string" and back.columns == df.columns
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    assert len(glob.glob(f"{snapshot_path(root, 1)}/p=007/*.parquet")) > 1


def test_staging_is_replaced_by_a_rerun_and_append_adds(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "k int")
    path = write_staging(df, str(tmp_path), "t", "initial", "r1")
    assert write_staging(df, str(tmp_path), "t", "initial", "r1") == path
    assert read_path(spark, path).count() == 1
    append_rows(df, str(tmp_path / "a"))
    append_rows(df, str(tmp_path / "a"))
    assert read_path(spark, str(tmp_path / "a")).count() == 2


def test_quarantine(spark, tmp_path):
    root = str(tmp_path / "dlq")
    df = spark.createDataFrame([(1, ["A"]), (2, ["A", "B"])], "k int, _failed_rules array<string>")
    folder = write_quarantine(df, root, "silver", "customers", "run-1", DAY)
    write_quarantine(df, root, "silver", "customers", "run-1", DAY)
    write_quarantine(df.limit(1), root, "silver", "orders", "run-2", DAY)
    assert plain(quarantine_summary(spark, root)) == [("silver", "customers", "run-1", 2), ("silver", "orders", "run-2", 1)]
    lines = [json.loads(text) for path in glob.glob(f"{folder}/*.json") for text in open(path)]
    assert len(lines) == 2
    assert all(line["_pipeline_run_id"] == "run-1" and "_rejection_timestamp" in line for line in lines)


def test_reference_audit(spark, tmp_path):
    root = str(tmp_path / "dlq")
    orders = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "order_id int, customer_id int")
    customers = spark.createDataFrame([(10,)], "customer_id int")
    args = ("customer_id", customers, "customer_id", "DQ-R-001", ["order_id", "customer_id"], "orders", "r1", DAY, root)
    run_reference_audit(orders, *args)
    assert plain(quarantine_summary(spark, root)) == [("audit", "orders", "r1", 2)]


def test_clustering_keeps_rows_and_narrows_files(spark):
    df = spark.range(0, 20000, 1, 4).selectExpr(
        "CASE WHEN id < 7000 THEN 500L ELSE pmod(xxhash64(id), 1000) END AS a", "pmod(xxhash64(id, 1), 1000) AS b",
        "'k' || pmod(xxhash64(id, 2), 1000) AS s", "id",
    )
    for columns in (["a"], ["a", "b"], ["a", "s"]):
        placed = clustered(df, columns, partitions=16)
        assert placed.columns == df.columns
        assert placed.exceptAll(df).count() == 0 and placed.count() == df.count()
        files = placed.withColumn("f", F.spark_partition_id()).groupBy("f").agg(
            F.count("*").alias("n"), *[(F.max(c) - F.min(c)).alias(c) for c in columns if c != "s"]
        ).collect()
        assert len(files) >= 12
        # A value with a third of the rows is spread: no file holds more than a small multiple of its share.
        assert max(r["n"] for r in files) < 3 * df.count() / 16
        for column in columns:
            if column != "s":
                assert sum(r[column] for r in files) / len(files) < 700


def test_catalog(spark, tmp_path):
    create_database(spark, "shop", str(tmp_path / "db"))
    root = str(tmp_path / "parts")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DIM_PRODUCT.fields)
    row = spark.createDataFrame([(1, 1, "s", "n", None, None, None, None, "a", "b", None, "r")], columns)
    write_snapshot(row, root, 1)
    register_table(spark, "shop.dim_product", DIM_PRODUCT, snapshot_path(root, 1))
    assert spark.table("shop.dim_product").schema == DIM_PRODUCT
    assert spark.table("shop.dim_product").count() == 1
    by_day = str(tmp_path / "days")
    facts = spark.createDataFrame([(20240101, 5), (20240102, 6)], "d int, n int")
    write_snapshot(facts, by_day, 1, ["d"])
    register_table(spark, "shop.facts", facts.schema, snapshot_path(by_day, 1), ["d"])
    assert sorted(r["d"] for r in spark.table("shop.facts").collect()) == [20240101, 20240102]
    write_snapshot(row.union(row), root, 2)
    publish(spark, "shop.products_now", root, 1)
    assert spark.table("shop.products_now").count() == 1
    publish(spark, "shop.products_now", root, 2)
    assert spark.table("shop.products_now").count() == 2


def test_raw_loads(spark, tmp_path):
    root = str(tmp_path)
    source = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    state = run_initial_load(source, root, "t", "r1", DAY)
    assert plain(state.select("k", "v", "_cdc_operation")) == [(1, "a", "F"), (2, "b", "F")]
    changes = spark.createDataFrame(
        [(1, "old", 4, 1, 1), (1, "new", 4, 7, 2), (2, None, 1, 8, 3), (3, "c", 2, 9, 4)],
        "k int, v string, _cdc_operation_code int, _cdc_version int, _cdc_seq int",
    )
    after = run_incremental_load(state, changes, ["k"], root, "t", 2, "r2", DAY, last=1)
    assert plain(after.state.select("k", "v", "_cdc_operation")) == [(1, "new", "UPDATE"), (3, "c", "INSERT")]
    assert plain(after.metrics) == [(3, 1, 9, "r2")]
    again = run_incremental_load(after.state, changes, ["k"], root, "t", 3, "r3", DAY, last=9)
    assert plain(again.metrics) == [(0, 0, 9, "r3")]
    assert plain(again.state.select("k", "v")) == plain(after.state.select("k", "v"))
    assert plain(read_snapshot(spark, f"{root}/t", 1)) == plain(state)


def test_loads_by_setting(spark, tmp_path):
    root = str(tmp_path)
    row = {"table_name": "t", "primary_key_columns": "k", "load_type": "FULL"}
    source = spark.createDataFrame([(1, "a", 5), (2, "b", 7)], "k int, v string, at int")
    copied = run_raw_load(RawConfig.from_row(row), source, None, root, 1, "r1", DAY)
    assert plain(copied.metrics) == [(2, 0, None, "r1")]
    changes = spark.createDataFrame(
        [(1, "x", 4, 3, 1), (2, None, 1, 4, 2)], "k int, v string, _cdc_operation_code int, _cdc_version int, _cdc_seq int"
    )
    ready = RawConfig.from_row({**row, "load_type": "CDC", "initial_load_completed": "true", "last_sync_version": 3})
    changed = run_raw_load(ready, changes, copied.state, root, 2, "r2", DAY)
    assert plain(changed.metrics) == [(1, 1, 4, "r2")]
    assert plain(changed.state, "k", "v") == [(1, "a")]
    later = spark.createDataFrame([(2, "B", 7), (3, "c", 9), (4, "n", None), (1, "late", 6)], "k int, v string, at int")
    marked = RawConfig.from_row({**row, "load_type": "WATERMARK", "watermark_column": "at", "last_sync_version": 7})
    newest = run_raw_load(marked, later, source, root, 3, "r3", DAY)
    assert plain(newest.state, "k", "v") == [(1, "a"), (2, "B"), (3, "c"), (4, "n")]
    assert plain(newest.metrics) == [(3, 0, 9, "r3")]
    with pytest.raises(ValueError, match="unknown load type"):
        RawConfig.from_row({**row, "load_type": "SOMETIMES"})
    with pytest.raises(ValueError, match="watermark"):
        RawConfig.from_row({**row, "load_type": "WATERMARK"})


def test_times_are_partitioned_by_day(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(48).selectExpr("id", "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id) AS at")
    back = write_snapshot(df, root, 1, ["at"])
    assert plain(back) == plain(df)
    assert len(glob.glob(f"{snapshot_path(root, 1)}/at_day=*")) == 2


def test_a_failed_write_does_not_block_the_next(spark, tmp_path):
    root = str(tmp_path)
    half = spark.range(3)
    half.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(snapshot_path(root, 1))
    assert plain(write_snapshot(spark.range(5), root, 1)) == [(i,) for i in range(5)]
    with pytest.raises(PySparkException, match="PATH_ALREADY_EXISTS"):
        write_snapshot(spark.range(5), root, 1)


def test_silver_load_that_fails_between_its_writes(spark, tmp_path, monkeypatch):
    root, dlq = str(tmp_path / "silver"), str(tmp_path / "dlq/with space")
    rows = spark.createDataFrame([(1, "ann", 5), (3, "cy", -1)], "id int, name string, age int")

    def fails(*_, **__):
        raise OSError("no room")

    with monkeypatch.context() as broken:
        broken.setattr("sedimenta.plans.silver.write_snapshot", fails)
        with pytest.raises(OSError):
            run_silver(rows, None, CONFIG, RULES, root, 1, "r1", DAY, dlq)
    run_silver(rows, None, CONFIG, RULES, root, 1, "r1", DAY, dlq)
    assert plain(quarantine_summary(spark, dlq)) == [("silver", "people", "r1", 1)]
    assert read_snapshot(spark, f"{root}/people", 1).count() == 1


def test_text_clusters_by_whole_values(spark):
    df = spark.range(0, 15000, 1, 4).selectExpr("format_string('Customer#%09d', id) AS name", "'ORD-' || id AS number", "id")
    placed = clustered(df, ["name", "number"], partitions=64).cache()
    assert plain(placed) == plain(df)
    spans = placed.groupBy(F.spark_partition_id()).agg(F.min("name").alias("a"), F.max("name").alias("b")).collect()
    assert len(spans) > 32
    # A filter on either column skips most files.
    for column in ("name", "number"):
        value = df.filter("id = 7777").first()[column]
        hit = placed.groupBy(F.spark_partition_id()).agg(
            ((F.min(column) <= value) & (F.max(column) >= value)).alias("hit")
        ).filter("hit").count()
        assert hit <= 24, column


CONFIG = TableConfig("people", ("id",), 2, ("name",), cluster_by=("id", "name"))
RULES = [Rule("N", NULL_CHECK, "name", "name IS NOT NULL", ERROR), Rule("V", RANGE_CHECK, "age", "age > 0")]


def test_silver_load_end_to_end(spark, tmp_path):
    root, dlq = str(tmp_path / "silver"), str(tmp_path / "dlq")
    first = spark.createDataFrame([(1, " ann ", 5), (2, "  ", 5), (3, "cy", -1)], "id int, name string, age int")
    assert run_silver(first, None, CONFIG, RULES, root, 1, "r1", DAY, dlq).first().asDict() == {
        "records_read": 3,
        "records_written": 1,
        "records_quarantined": 2,
        "pipeline_run_id": "r1",
        "table_name": "people",
    }
    state = read_snapshot(spark, f"{root}/people", 1)
    second = spark.createDataFrame([(1, "anna", 6), (3, "cy", 7)], "id int, name string, age int")
    run_silver(second, state, CONFIG, RULES, root, 2, "r2", "2024-02-01 00:00:00", dlq)
    result = read_snapshot(spark, f"{root}/people", 2).select("id", "name", "_is_current", "_pipeline_run_id")
    assert plain(result) == [(1, "ann", False, "r1"), (1, "anna", True, "r2"), (3, "cy", True, "r2")]
    assert plain(quarantine_summary(spark, dlq)) == [("silver", "people", "r1", 2)]
    lazily = silver_transform(second, state, CONFIG, RULES, "r2", "2024-02-01 00:00:00")
    assert plain(lazily.state.select(*result.columns)) == plain(result) and lazily.rejected.count() == 0

    twice = spark.createDataFrame([(1, "a", 6), (1, "b", 7)], "id int, name string, age int")
    with pytest.raises(ValueError, match="share one key"):
        run_silver(twice, state, CONFIG, RULES, root, 3, "r3", DAY, dlq)
    with pytest.raises(PySparkException, match="breaks rules: N"):
        run_silver(first, state, CONFIG, RULES, root, 4, "r4", DAY, dlq, on_error="fail")


def test_upsert_into_partitions(spark, tmp_path):
    root = str(tmp_path / "facts")
    create_database(spark, "sales", str(tmp_path / "sales"))
    columns = "order_number string, n int, d int"
    rows = [("A", 1, 20240101), ("B", 2, 20240102), ("C", 3, 20240103), ("D", 4, 20240103), ("E", 5, 20240104)]
    write_snapshot(spark.createDataFrame(rows, columns), root, 1, ["d"])
    register_table(spark, "sales.orders", spark.createDataFrame([], columns).schema, snapshot_path(root, 1), ["d"])
    # B moves away and leaves its day empty, C changes, F opens a new day.
    batch = spark.createDataFrame([("B", 20, 20240104), ("C", 30, 20240103), ("F", 6, 20240105)], columns)
    touched = upsert_into_partitions("sales.orders", batch, ["order_number"], "d", root, 2)
    assert sorted(touched) == [20240102, 20240103, 20240104, 20240105]
    expected = [("A", 1, 20240101), ("B", 20, 20240104), ("C", 30, 20240103), ("D", 4, 20240103), ("E", 5, 20240104), ("F", 6, 20240105)]
    assert plain(spark.table("sales.orders")) == expected
    assert not glob.glob(f"{snapshot_path(root, 2)}/d=20240101*")
    target = spark.table("sales.orders")
    plan = upsert_touched(target, batch, ["order_number"], "d", [20240103])._jdf.queryExecution().executedPlan().toString()
    assert "(d#" in plan[plan.index("PartitionFilters") :][:60]
    with pytest.raises(ValueError, match="no partition"):
        upsert_touched(target, batch, ["order_number"], "d", [None])
    # The same batch again changes nothing; the table now reads from several version folders.
    upsert_into_partitions("sales.orders", batch, ["order_number"], "d", root, 3)
    assert plain(spark.table("sales.orders")) == expected
    assert sorted(r[0] for r in spark.sql("SHOW PARTITIONS sales.orders").collect()) == [
        "d=20240101", "d=20240103", "d=20240104", "d=20240105",
    ]


def test_bucketed_target_is_not_shuffled(spark, tmp_path):
    create_database(spark, "buckets", str(tmp_path / "db"))
    rows = spark.range(0, 20000, 1, 4).selectExpr("id AS k", "'old' AS v")
    target = write_bucketed(rows.repartition(8, "k"), "buckets.t1", str(tmp_path / "t1"), ["k"], 8)
    batch = spark.range(0, 6000, 1, 4).selectExpr("id * 5 AS k", "'new' AS v").repartition(8, "k")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        state = upsert(target, batch, ["k"])
        plan = state._jdf.queryExecution().executedPlan().toString()
        scan = plan[: plan.index("t1")]
        assert "SortMergeJoin" in scan and "Exchange" not in scan
        after = write_bucketed(state, "buckets.t2", str(tmp_path / "t2"), ["k"], 8)
        assert after.count() == 20000 + 2000 and after.filter("v = 'new'").count() == 6000
        assert len(glob.glob(str(tmp_path / "t2" / "*.parquet"))) <= 16
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
