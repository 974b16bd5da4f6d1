"""Raw layer: loads, change rows, watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.config import RawConfig
from sedimenta.functions.columns import month_key
from sedimenta.functions.evolution import union_nested
from sedimenta.operators.changes import (
    apply_changes,
    decode_changes,
    duplicate_keys,
    high_water_mark,
    latest_per_key,
)
from sedimenta.operators.merge import replace_where, union_evolving
from sedimenta.plans.bronze import (
    initial_load,
    run_bucket_copy,
    run_bucket_load,
    run_incremental_load,
    run_initial_load,
    run_raw_load,
    watermark_load,
)
from sedimenta.session import fresh_path, stored
from sedimenta.sinks.clusters import append_clusters, cluster_again, start_clusters
from sedimenta.sinks.layout import clustered
from sedimenta.sinks.tables import append_rows, write_snapshot
from sedimenta.sources.feeds import changes_after, in_log_order
from sedimenta.sources.tables import read_snapshot
from workload.inputs import CHANGE_LOAD, FIRST_LOAD, RUN_1, RUN_2, SECOND_LOAD, frame, latest_sql, table, with_inputs
from workload.registry import ORACLES, query

KEY = ["user_id"]
ORDER = ("_cdc_version", "_cdc_seq")

_DECODED = """
decoded AS (
  SELECT *, CASE _cdc_operation_code WHEN 1 THEN 'DELETE' WHEN 2 THEN 'INSERT' WHEN 4 THEN 'UPDATE'
            ELSE 'UNKNOWN' END AS _cdc_operation
  FROM changes WHERE _cdc_operation_code <> 3)
"""
_LATEST = f"latest AS ({latest_sql('decoded', 'user_id', '_cdc_version DESC, _cdc_seq DESC')})"


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return initial_load(frame(spark, sf_dir, "accounts"), RUN_1, FIRST_LOAD)


@query(
    "bronze_initial_load",
    f"""SELECT *, 'F' AS _cdc_operation, '{RUN_1}' AS _pipeline_run_id,
               TIMESTAMP '{FIRST_LOAD}' AS _ingest_timestamp FROM orders""",
)
def bronze_initial_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return initial_load(table(spark, sf_dir, "orders"), RUN_1, FIRST_LOAD)


@query(
    "cdc_incremental_read",
    with_inputs(
        ["changes"],
        "",
        """SELECT * FROM changes
           WHERE _cdc_version > (SELECT max(_cdc_version) FROM changes
                                 WHERE _change_timestamp < TIMESTAMP '2024-01-03 00:00:00')
           ORDER BY _cdc_version, _cdc_seq""",
    ),
)
def cdc_incremental_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = frame(spark, sf_dir, "changes")
    applied = high_water_mark(changes.filter("_change_timestamp < TIMESTAMP '2024-01-03 00:00:00'"))
    return in_log_order(changes_after(changes, applied.scalar()))


@query("cdc_decode_ops", with_inputs(["changes"], _DECODED, "SELECT * FROM decoded"))
def cdc_decode_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_changes(frame(spark, sf_dir, "changes"))


@query("latest_per_key", with_inputs(["changes"], f"{_DECODED}, {_LATEST}", "SELECT * FROM latest"))
def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(decode_changes(frame(spark, sf_dir, "changes")), KEY, ORDER)


@query(
    "cdc_apply_merge",
    with_inputs(
        ["changes", "accounts"],
        f"{_DECODED}, {_LATEST}",
        f"""SELECT user_id, value, 'F' AS _cdc_operation, '{RUN_1}' AS _pipeline_run_id,
                   TIMESTAMP '{FIRST_LOAD}' AS _ingest_timestamp
            FROM accounts WHERE user_id NOT IN (SELECT user_id FROM latest)
            UNION ALL
            SELECT user_id, value, _cdc_operation, '{RUN_2}', TIMESTAMP '{CHANGE_LOAD}'
            FROM latest WHERE _cdc_operation <> 'DELETE'""",
    ),
)
def cdc_apply_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_changes(
        _accounts(spark, sf_dir), frame(spark, sf_dir, "changes"), KEY, RUN_2, CHANGE_LOAD, ORDER
    )


@query("cdc_high_water_mark", with_inputs(["changes"], "", "SELECT max(_cdc_version) AS high_water_mark FROM changes"))
def cdc_high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_water_mark(frame(spark, sf_dir, "changes"))


@query(
    "watermark_incremental",
    with_inputs(
        ["profile_1", "profile_all"],
        f"""older AS ({latest_sql('profile_1', 'customer_id', 'last_order_date DESC, last_order_id DESC')}),
            newest AS ({latest_sql('profile_all', 'customer_id', 'last_order_date DESC, last_order_id DESC')}),
            fresh AS (SELECT * FROM newest WHERE last_order_date >= (SELECT max(last_order_date) FROM older)
                      OR last_order_date IS NULL)""",
        """SELECT customer_id, customer_type, status, last_order_id, last_order_date FROM older
           WHERE customer_id NOT IN (SELECT customer_id FROM fresh)
           UNION ALL SELECT customer_id, customer_type, status, last_order_id, last_order_date FROM fresh""",
    ),
)
def watermark_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = ("last_order_date", "last_order_id")
    older_rows, every = frame(spark, sf_dir, "profile_1"), frame(spark, sf_dir, "profile_all")
    keep = ["customer_id", "customer_type", "status", "last_order_id", "last_order_date"]
    older = stored(latest_per_key(older_rows.select(*keep), ["customer_id"], newest), "older")
    source = latest_per_key(every.select(*keep), ["customer_id"], newest)
    last = older.agg(F.max("last_order_date")).scalar()
    return watermark_load(older, source, ["customer_id"], "last_order_date", last)


@query(
    "merge_source_duplicates",
    """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def merge_source_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "schema_evolution_union",
    """SELECT c_custkey AS party_id, c_name AS party_name, c_acctbal AS balance, c_mktsegment AS segment,
              NULL::INTEGER AS nation_id FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, s_nationkey FROM supplier""",
)
def schema_evolution_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    older = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS party_id", "c_name AS party_name", "c_acctbal AS balance", "c_mktsegment AS segment"
    )
    newer = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS party_id", "s_nationkey AS nation_id", "s_name AS party_name", "s_acctbal AS balance"
    )
    return union_evolving(older, newer)


@query(
    "schema_evolution_nested",
    """SELECT CAST(c_custkey AS BIGINT) AS party_id, c_name AS party_name, CAST(c_nationkey AS BIGINT) AS nation, NULL::VARCHAR AS city,
              CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS amount, NULL::VARCHAR AS currency, 1 AS accounts FROM customer
       UNION ALL
       SELECT s_suppkey, s_name, s_nationkey, 'city ' || CAST(s_nationkey AS VARCHAR),
              CAST(CAST(s_acctbal AS DECIMAL(14,1)) AS DOUBLE), 'EUR', 2 FROM supplier""",
)
def schema_evolution_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structs and arrays of structs that got fields and wider numbers since, in one table."""
    older = table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS INT) AS party_id",
        "struct(c_name AS name, struct(CAST(c_nationkey AS INT) AS nation) AS home) AS party",
        "array(struct(CAST(c_acctbal AS DECIMAL(12,2)) AS amount)) AS accounts",
    )
    newer = table(spark, sf_dir, "supplier").selectExpr(
        "CAST(s_suppkey AS BIGINT) AS party_id",
        "array(struct('EUR' AS currency, CAST(s_acctbal AS DECIMAL(14,1)) AS amount), NULL) AS accounts",
        "struct(struct('city ' || s_nationkey AS city, CAST(s_nationkey AS BIGINT) AS nation) AS home, s_name AS name) AS party",
    )
    return union_nested(older, newer).selectExpr(
        "party_id",
        "party.name AS party_name",
        "party.home.nation AS nation",
        "party.home.city AS city",
        "accounts[0].amount AS amount",
        "accounts[0].currency AS currency",
        "size(accounts) AS accounts",
    )


@query(
    "replace_where",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
        WHERE NOT coalesce(o_orderdate >= TIMESTAMP '{SECOND_LOAD}', FALSE)
        UNION ALL SELECT o_orderkey, o_custkey, 'R', o_totalprice, o_orderdate FROM orders
        WHERE o_orderdate >= TIMESTAMP '{SECOND_LOAD}' AND o_orderstatus <> 'P'""",
)
def replace_where_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    predicate = f"o_orderdate >= TIMESTAMP '{SECOND_LOAD}'"
    new = old.filter(predicate).filter("o_orderstatus <> 'P'").withColumn("o_orderstatus", F.lit("R"))
    return replace_where(old, new, predicate)


@query("cluster_layout", "SELECT * FROM orders")
def cluster_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"])


@query("cluster_incremental", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def cluster_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders clustered, later ones appended, then only overlapping files clustered again."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    root, early = fresh_path(spark, "clusters"), f"coalesce(o_orderdate < TIMESTAMP '{SECOND_LOAD}', TRUE) AND o_orderkey % 5 > 0"
    start_clusters(orders.filter(early), ["o_orderdate", "o_custkey"], root)
    append_clusters(orders.filter(f"NOT ({early})"), root, 2)
    return cluster_again(spark, root, 3)


# ---- loads with their writes -----------------------------------------------


@query(
    "bronze_incremental_load",
    with_inputs(
        ["changes", "accounts"],
        f"""applied AS (SELECT max(_cdc_version) AS last FROM changes
                        WHERE _change_timestamp < TIMESTAMP '2024-01-03 00:00:00'),
            {_DECODED},
            fresh AS (SELECT * FROM decoded WHERE _cdc_version > (SELECT last FROM applied)),
            latest AS ({latest_sql('fresh', 'user_id', '_cdc_version DESC, _cdc_seq DESC')})""",
        f"""SELECT user_id, value, 'F' AS _cdc_operation, '{RUN_1}' AS _pipeline_run_id,
                   TIMESTAMP '{FIRST_LOAD}' AS _ingest_timestamp
            FROM accounts WHERE user_id NOT IN (SELECT user_id FROM latest)
            UNION ALL
            SELECT user_id, value, _cdc_operation, '{RUN_2}', TIMESTAMP '{CHANGE_LOAD}'
            FROM latest WHERE _cdc_operation <> 'DELETE'""",
    ),
)
def bronze_incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage, write version 1; stage the changes behind the mark, write version 2; read it back."""
    root, changes = fresh_path(spark, "raw"), frame(spark, sf_dir, "changes")
    state = run_initial_load(frame(spark, sf_dir, "accounts"), root, "accounts", RUN_1, FIRST_LOAD, KEY)
    applied = high_water_mark(changes.filter("_change_timestamp < TIMESTAMP '2024-01-03 00:00:00'"))
    return run_incremental_load(
        state, changes, KEY, root, "accounts", 2, RUN_2, CHANGE_LOAD, applied.scalar(), cluster_by=KEY
    ).state


def _bucket_sql(runs: list[tuple[str, str]]) -> str:
    """Accounts after all changes; a row's run is the first whose window holds the key's last change."""
    run = " ".join(f"WHEN {window} THEN '{name}'" for name, window in runs)
    return with_inputs(
        ["changes", "accounts"],
        f"{_DECODED}, {_LATEST}",
        f"""SELECT user_id, value, 'F' AS _cdc_operation, '{RUN_1}' AS _pipeline_run_id,
                   TIMESTAMP '{FIRST_LOAD}' AS _ingest_timestamp
            FROM accounts WHERE user_id NOT IN (SELECT user_id FROM latest)
            UNION ALL
            SELECT user_id, value, _cdc_operation, CASE {run} END, TIMESTAMP '{CHANGE_LOAD}'
            FROM latest WHERE _cdc_operation <> 'DELETE'""",
    )


_EARLY, _LATE = (f"_change_timestamp {op} TIMESTAMP '2024-01-15 00:00:00'" for op in ("<", ">="))


@query("cdc_apply_buckets", _bucket_sql([(RUN_2, _EARLY), ("run-3", _LATE)]))
def cdc_apply_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy in key-hash folders and two loads of changes, which write the folders they change."""
    root, changes = fresh_path(spark, "raw"), frame(spark, sf_dir, "changes")
    run_bucket_copy(frame(spark, sf_dir, "accounts"), KEY, root, "accounts", 32, RUN_1, FIRST_LOAD)
    run_bucket_load(changes.filter(_EARLY), KEY, root, "accounts", 2, RUN_2, CHANGE_LOAD)
    return run_bucket_load(changes.filter(_LATE), KEY, root, "accounts", 3, "run-3", CHANGE_LOAD).state


# Windows in the order in which they arrive: one that is late, overlaps, all again.
_WINDOWS = [
    ("middle", "_change_timestamp >= TIMESTAMP '2024-01-10 00:00:00' AND _change_timestamp < TIMESTAMP '2024-01-20 00:00:00'"),
    ("late", "_change_timestamp < TIMESTAMP '2024-01-12 00:00:00'"),
    ("newest", "_change_timestamp >= TIMESTAMP '2024-01-18 00:00:00'"),
    ("again", "TRUE"),
]


@query("cdc_replay_window", _bucket_sql(_WINDOWS))
def cdc_replay_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that overlap, come late and come twice leave what one pass in order would."""
    root, changes = fresh_path(spark, "raw"), frame(spark, sf_dir, "changes")
    run_bucket_copy(frame(spark, sf_dir, "accounts"), KEY, root, "accounts", 32, RUN_1, FIRST_LOAD)
    for version, (run, window) in enumerate(_WINDOWS, 2):
        load = run_bucket_load(changes.filter(window), KEY, root, "accounts", version, run, CHANGE_LOAD)
    return load.state


_PART_METRICS = """SELECT '{run}' AS _pipeline_run_id, count(*) AS records_read,
  count(*) FILTER (WHERE _cdc_operation_code = 1) AS records_deleted, max(_cdc_version) AS high_water_mark
FROM changes WHERE {rows}"""
_UNTIL = "2024-01-15 00:00:00"


@query(
    "bronze_load_metrics",
    with_inputs(
        ["changes"],
        f"first_load AS ({_PART_METRICS.format(run=RUN_1, rows=f"_change_timestamp <= TIMESTAMP '{_UNTIL}'")})",
        f"""SELECT * FROM first_load UNION ALL
            {_PART_METRICS.format(run=RUN_2, rows='_cdc_version > (SELECT high_water_mark FROM first_load)')}""",
    ),
)
def bronze_load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads in a row; the second goes on from the mark that the first returned."""
    root, changes = fresh_path(spark, "raw"), frame(spark, sf_dir, "changes")
    state = stored(_accounts(spark, sf_dir), "accounts")
    first = run_incremental_load(state, changes, KEY, root, "accounts", 1, RUN_1, CHANGE_LOAD, until=_UNTIL)
    mark = first.metrics.first()["high_water_mark"]
    second = run_incremental_load(first.state, changes, KEY, root, "accounts", 2, RUN_2, CHANGE_LOAD, mark)
    return first.metrics.unionByName(second.metrics)


@query(
    "config_driven_load",
    with_inputs(
        ["changes", "accounts"],
        f"{_DECODED}, {_LATEST}",
        f"""SELECT user_id, value, 'F' AS _cdc_operation, '{RUN_1}' AS _pipeline_run_id,
                   TIMESTAMP '{FIRST_LOAD}' AS _ingest_timestamp
            FROM accounts WHERE user_id NOT IN (SELECT user_id FROM latest)
            UNION ALL
            SELECT user_id, value, _cdc_operation, '{RUN_2}', TIMESTAMP '{CHANGE_LOAD}'
            FROM latest WHERE _cdc_operation <> 'DELETE'""",
    ),
)
def config_driven_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table's settings row asks for a full copy first, then for changes."""
    root = fresh_path(spark, "raw")
    row = {"table_name": "accounts", "primary_key_columns": "user_id", "load_type": "CDC"}
    copied = run_raw_load(
        RawConfig.from_row(row), frame(spark, sf_dir, "accounts"), None, root, 1, RUN_1, FIRST_LOAD
    )
    later = RawConfig.from_row({**row, "initial_load_completed": True, "last_sync_version": -1})
    changes = frame(spark, sf_dir, "changes")
    return run_raw_load(later, changes, copied.state, root, 2, RUN_2, CHANGE_LOAD).state


@query(
    "cdc_window_read",
    with_inputs(
        ["changes"],
        "",
        """SELECT * FROM changes WHERE _change_timestamp >= TIMESTAMP '2024-01-03 00:00:00'
           AND _change_timestamp <= TIMESTAMP '2024-01-20 00:00:00'""",
    ),
)
def cdc_window_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes_after(
        frame(spark, sf_dir, "changes"),
        since=F.lit("2024-01-03 00:00:00").cast("timestamp"),
        until=F.lit("2024-01-20 00:00:00").cast("timestamp"),
    )


@query("append_rows", "SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'P'")
def append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is only added to, after two writes."""
    orders, path = table(spark, sf_dir, "orders"), fresh_path(spark, "log")
    append_rows(orders, path, ["o_orderstatus"])
    append_rows(orders.filter("o_orderstatus = 'P'"), path, ["o_orderstatus"])
    return spark.read.schema(orders.schema).parquet(path)


@query("cluster_layout_text", "SELECT * FROM customer")
def cluster_layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "customer"), ["c_name", "c_mktsegment"])


@query("snapshot_time_travel", ORACLES["bronze_initial_load"])
def snapshot_time_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version 1 as it still reads after version 2 (other columns, fewer rows) was written."""
    root = fresh_path(spark, "versions")
    first = initial_load(table(spark, sf_dir, "orders"), RUN_1, FIRST_LOAD)
    write_snapshot(first, root, 1)
    write_snapshot(read_snapshot(spark, root, 1).filter("o_orderstatus = 'O'").select("o_orderkey"), root, 2)
    return read_snapshot(spark, root, 1)


@query(
    "partitioned_write",
    """SELECT *, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS month_key FROM orders""",
)
def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in one folder per month, clustered by customer and order within the month."""
    orders = table(spark, sf_dir, "orders").withColumn("month_key", month_key("o_orderdate"))
    return write_snapshot(
        orders, fresh_path(spark, "by-month"), 1, ["month_key"], ["o_custkey", "o_orderkey"]
    )
