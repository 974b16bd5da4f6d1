"""Conformed layer: cleanup, rules, current state and history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.config import ERROR, FORMAT_CHECK, NULL_CHECK, RANGE_CHECK, REF_INTEGRITY, WARNING, Rule, TableConfig
from sedimenta.functions.columns import row_hash, with_audit
from sedimenta.functions.strings import cast_timestamps, clean_strings
from sedimenta.operators.audit import next_orphans
from sedimenta.operators.changes import latest_per_key
from sedimenta.operators.history import (
    current_rows,
    scd2_apply,
    scd2_changed_keys,
    scd2_expired_rows,
    scd2_initial,
    scd2_new_rows,
)
from sedimenta.operators.merge import upsert
from sedimenta.operators.quality import (
    exception_summary,
    load_metrics,
    orphan_rows,
    rejected_rows,
    table_rules,
    tag_rows,
    valid_rows,
    warned_rows,
)
from sedimenta.plans.replay import replay_quarantine
from sedimenta.plans.silver import run_silver, silver_transform
from sedimenta.session import fresh_path, stored
from sedimenta.sinks.buckets import BUCKET, load_history, start_history
from sedimenta.sinks.tables import write_quarantine
from sedimenta.sources.tables import quarantine_summary, read_snapshot
from workload.inputs import (
    AS_OF_DAY,
    FIRST_LOAD,
    RUN_1,
    RUN_2,
    RUN_3,
    SECOND_LOAD,
    THIRD_LOAD,
    frame,
    latest_sql,
    table,
    with_inputs,
)
from workload.registry import query

# Fixed value: the address pattern of the e-mail rule.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"

# The rule ids below.
EMAIL_PRESENT = Rule("DQ-N-001", NULL_CHECK, "email", "email IS NOT NULL", ERROR)
EMAIL_FORMAT = Rule("DQ-F-001", FORMAT_CHECK, "email", f"email RLIKE r'{EMAIL_PATTERN}'")
BALANCE_POSITIVE = Rule("DQ-V-001", RANGE_CHECK, "balance", "balance > 0")
TYPE_PRESENT = Rule("DQ-W-001", NULL_CHECK, "customer_type", "customer_type IS NOT NULL", WARNING)
CUSTOMER_RULES = [EMAIL_PRESENT, EMAIL_FORMAT, BALANCE_POSITIVE, TYPE_PRESENT]
CUSTOMER_EXISTS = Rule(
    "DQ-R-001", REF_INTEGRITY, "o_custkey", parent="customers", parent_column="c_custkey"
)

KEY = ["customer_id"]
TRACKED = ["status", "customer_type"]
NEWEST = ("last_order_date", "last_order_id")

# ---- cleanup and rules -------------------------------------------------

_CLEANED = """
cleaned AS (
  SELECT customer_id, nullif(trim(name), '') AS name, nullif(trim(email), '') AS email,
         nullif(trim(customer_type), '') AS customer_type, nullif(trim(status), '') AS status, balance
  FROM raw_customers)
"""
_CHECKED = f"""
{_CLEANED},
checked AS (
  SELECT *, email IS NOT NULL AS n1, coalesce(regexp_matches(email, '{EMAIL_PATTERN}'), FALSE) AS f1,
         coalesce(balance > 0, FALSE) AS v1, customer_type IS NOT NULL AS w1
  FROM cleaned)
"""
_ROW = "customer_id, name, email, customer_type, status, balance"
_FAILED = (
    "concat_ws(',', CASE WHEN NOT n1 THEN 'DQ-N-001' END, CASE WHEN NOT f1 THEN 'DQ-F-001' END, "
    "CASE WHEN NOT v1 THEN 'DQ-V-001' END)"
)


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_strings(frame(spark, sf_dir, "raw_customers"))


@query("clean_strings", with_inputs(["raw_customers"], _CLEANED, "SELECT * FROM cleaned"))
def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir)


@query(
    "cast_timestamps",
    """SELECT o_orderkey, TRY_CAST(CASE o_orderstatus WHEN 'P' THEN 'pending'
                ELSE substr(CAST(o_orderdate AS STRING), 1, 19) END AS TIMESTAMP) AS ordered_at FROM orders""",
)
def cast_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "CASE o_orderstatus WHEN 'P' THEN 'pending' ELSE substr(CAST(o_orderdate AS STRING), 1, 19) END AS ordered_at",
    )
    return cast_timestamps(text, ["ordered_at"])


@query(
    "dq_valid_rows",
    with_inputs(["raw_customers"], _CHECKED, f"SELECT {_ROW} FROM checked WHERE n1 AND f1 AND v1"),
)
def dq_valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_rows(_cleaned(spark, sf_dir), CUSTOMER_RULES)


@query(
    "dq_rejected_rows",
    with_inputs(
        ["raw_customers"],
        _CHECKED,
        f"SELECT {_ROW}, {_FAILED} AS _failed_rules FROM checked WHERE NOT (n1 AND f1 AND v1)",
    ),
)
def dq_rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_rows(_cleaned(spark, sf_dir), CUSTOMER_RULES)


@query(
    "dq_warnings",
    with_inputs(
        ["raw_customers"],
        _CHECKED,
        f"SELECT {_ROW}, 'DQ-W-001' AS _warnings FROM checked WHERE n1 AND f1 AND v1 AND NOT w1",
    ),
)
def dq_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warned_rows(_cleaned(spark, sf_dir), CUSTOMER_RULES)


@query(
    "dq_ref_integrity_rule",
    with_inputs(
        ["parents"],
        "",
        """SELECT o.*, CASE WHEN c.c_custkey IS NULL THEN 'DQ-R-001' ELSE '' END AS _failed_rules, '' AS _warnings,
              c.c_custkey IS NOT NULL AS _accepted
       FROM orders o LEFT JOIN parents c ON o.o_custkey = c.c_custkey""",
    ),
)
def dq_ref_integrity_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = {"customers": frame(spark, sf_dir, "parents")}
    return tag_rows(table(spark, sf_dir, "orders"), [CUSTOMER_EXISTS], parents)


@query(
    "dq_table_rules",
    """WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL),
            t AS (SELECT CAST(sum(n) AS DOUBLE) AS total,
                         CAST(sum(CASE WHEN l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL THEN n ELSE 0 END)
                              AS DOUBLE) AS complete,
                         CAST(count(*) FILTER (WHERE n = 1 AND l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL)
                              AS DOUBLE) AS once FROM k)
       SELECT 'RowCount' AS rule, total AS value, total > 0 AS passed FROM t
       UNION ALL SELECT 'IsComplete', complete / total, complete = total FROM t
       UNION ALL SELECT 'Uniqueness', once / total, once = total FROM t""",
)
def dq_table_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_rules(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_exception_summary",
    with_inputs(
        ["raw_customers"],
        _CHECKED,
        f"""SELECT '{RUN_2}' AS pipeline_run_id, rule_id, count(*) AS exception_count FROM (
              SELECT 'DQ-N-001' AS rule_id FROM checked WHERE NOT n1
              UNION ALL SELECT 'DQ-F-001' FROM checked WHERE NOT f1
              UNION ALL SELECT 'DQ-V-001' FROM checked WHERE NOT v1) GROUP BY rule_id""",
    ),
)
def dq_exception_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exception_summary(rejected_rows(_cleaned(spark, sf_dir), CUSTOMER_RULES), RUN_2)


@query(
    "load_metrics",
    with_inputs(
        ["raw_customers"],
        _CHECKED,
        f"""SELECT count(*) AS records_read, count(*) FILTER (WHERE n1 AND f1 AND v1) AS records_written,
                   count(*) FILTER (WHERE NOT (n1 AND f1 AND v1)) AS records_quarantined,
                   '{RUN_2}' AS pipeline_run_id FROM checked""",
    ),
)
def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_metrics(tag_rows(_cleaned(spark, sf_dir), CUSTOMER_RULES), RUN_2)


@query(
    "ri_orphans",
    with_inputs(
        ["parents"],
        "",
        """SELECT o_orderkey, o_custkey, 'DQ-R-001' AS rule_id FROM orders o
           WHERE NOT EXISTS (SELECT 1 FROM parents c WHERE c.c_custkey = o.o_custkey)""",
    ),
)
def ri_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    child = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parent = frame(spark, sf_dir, "parents")
    return orphan_rows(child, "o_custkey", parent, "c_custkey", "DQ-R-001")


def _audit_sql(load: int, until: str) -> str:
    return f"""SELECT {load} AS load, o_orderkey, o_custkey, 'DQ-R-001' AS rule_id FROM orders o
               WHERE {until} AND NOT EXISTS (SELECT 1 FROM parents_{load} c WHERE c.c_custkey = o.o_custkey)"""


_TRANCHES = [
    f"o_orderdate < TIMESTAMP '{FIRST_LOAD}'",
    f"o_orderdate >= TIMESTAMP '{FIRST_LOAD}' AND o_orderdate < TIMESTAMP '{SECOND_LOAD}'",
    f"NOT coalesce(o_orderdate < TIMESTAMP '{SECOND_LOAD}', FALSE)",
]


@query(
    "ri_orphans_maintained",
    with_inputs(
        ["parents_1", "parents_2", "parents_3"],
        "",
        " UNION ALL ".join(
            [_audit_sql(1, _TRANCHES[0]), _audit_sql(2, f"o_orderdate < TIMESTAMP '{SECOND_LOAD}'"), _audit_sql(3, "TRUE")]
        ),
    ),
)
def ri_orphans_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans after three loads of orders, the second with new parents, the third with lost ones."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    parents = [frame(spark, sf_dir, f"parents_{load}") for load in (1, 2, 3)]
    state, states = None, []
    for load, (tranche, now) in enumerate(zip(_TRANCHES, parents, strict=True), 1):
        before = parents[load - 2]
        state = next_orphans(
            state,
            ["o_orderkey"],
            "o_custkey",
            orders.filter(tranche).drop("o_orderdate"),
            now,
            "c_custkey",
            "DQ-R-001",
            new_parents=now.join(before, "c_custkey", "left_anti") if load > 1 else None,
            lost_parents=before.join(now, "c_custkey", "left_anti") if load > 1 else None,
            children=orders.drop("o_orderdate") if load == 3 else orders.filter(" OR ".join(f"({t})" for t in _TRANCHES[:load])).drop("o_orderdate"),
        )
        state = stored(state, "orphans")
        states.append(state.withColumn("load", F.lit(load)))
    return states[0].unionByName(states[1]).unionByName(states[2])


_REPLAYED = f"""
{_CHECKED},
e AS (SELECT *, email IS NOT NULL AS n1, coalesce(regexp_matches(email, '{EMAIL_PATTERN}'), FALSE) AS f1,
             coalesce(balance > 0, FALSE) AS v1 FROM earlier_customers),
ok1 AS (SELECT {_ROW} FROM checked WHERE n1 AND f1 AND v1), no1 AS (SELECT {_ROW} FROM checked WHERE NOT (n1 AND f1 AND v1)),
ok2 AS (SELECT {_ROW} FROM e WHERE n1 AND f1 AND v1), no2 AS (SELECT {_ROW} FROM e WHERE NOT (n1 AND f1 AND v1)),
state AS (SELECT *, '{RUN_2}' AS run, TIMESTAMP '{SECOND_LOAD}' AS since FROM ok2
          UNION ALL SELECT *, '{RUN_1}', TIMESTAMP '{FIRST_LOAD}' FROM ok1
          WHERE customer_id NOT IN (SELECT customer_id FROM ok2)),
waiting AS (SELECT *, TIMESTAMP '{SECOND_LOAD}' AS since FROM no2
            UNION ALL SELECT *, TIMESTAMP '{FIRST_LOAD}' FROM no1 WHERE customer_id NOT IN (SELECT customer_id FROM no2)),
again AS (SELECT {_ROW} FROM waiting w WHERE email IS NOT NULL AND balance > 0 - 500
          AND NOT EXISTS (SELECT 1 FROM state s WHERE s.customer_id = w.customer_id AND s.since > w.since))
"""


@query(
    "dlq_replay",
    with_inputs(
        ["raw_customers", "earlier_customers"],
        _REPLAYED,
        f"""SELECT {_ROW}, run AS _pipeline_run_id, since AS _load_timestamp FROM state
            WHERE customer_id NOT IN (SELECT customer_id FROM again)
            UNION ALL SELECT *, '{RUN_3}', TIMESTAMP '{THIRD_LOAD}' FROM again""",
    ),
)
def dlq_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads with rejections, then a replay under milder rules, run twice: every row that
    passes now is moved once, unless a later load has replaced it."""
    root = fresh_path(spark, "conformed")
    dlq, log = f"{root}-quarantine", f"{root}-log"
    config = TableConfig("customers", ("customer_id",), 1)
    loads = ((RUN_1, FIRST_LOAD, "raw_customers"), (RUN_2, SECOND_LOAD, "earlier_customers"))
    target = None
    for version, (run, as_of, name) in enumerate(loads, 1):
        source = frame(spark, sf_dir, name)
        run_silver(source, target, config, CUSTOMER_RULES, root, version, run, as_of, dlq, log_root=log)
        target = read_snapshot(spark, f"{root}/customers", version)
    milder = [EMAIL_PRESENT, Rule("DQ-V-002", RANGE_CHECK, "balance", "balance > -500"), TYPE_PRESENT]
    schema = clean_strings(frame(spark, sf_dir, "raw_customers")).schema
    for version, run in ((3, RUN_3), (3, RUN_3), (4, "run-4")):
        replay_quarantine(spark, schema, target, config, milder, root, version, run, THIRD_LOAD, dlq, log)
        target = read_snapshot(spark, f"{root}/customers", version)
    return target


@query(
    "dlq_summary",
    with_inputs(
        ["raw_customers", "parents"],
        _CHECKED,
        f"""SELECT 'silver' AS layer, 'customers' AS table_name, '{RUN_2}' AS run_id, count(*) AS row_count
            FROM checked WHERE NOT (n1 AND f1 AND v1) HAVING count(*) > 0
            UNION ALL
            SELECT 'audit', 'orders', '{RUN_2}', count(*) FROM orders o
            WHERE NOT EXISTS (SELECT 1 FROM parents c WHERE c.c_custkey = o.o_custkey)
            HAVING count(*) > 0""",
    ),
)
def dlq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_path(spark, "quarantine")
    refused = rejected_rows(_cleaned(spark, sf_dir), CUSTOMER_RULES)
    write_quarantine(refused, root, "silver", "customers", RUN_2, THIRD_LOAD)
    write_quarantine(ri_orphans(spark, sf_dir), root, "audit", "orders", RUN_2, THIRD_LOAD)
    return quarantine_summary(spark, root)


@query(
    "dlq_rerun",
    with_inputs(
        ["raw_customers"],
        _CHECKED,
        f"""SELECT 'silver' AS layer, 'my customers' AS table_name, '{RUN_2}' AS run_id, count(*) AS row_count
            FROM checked WHERE NOT (n1 AND f1 AND v1) HAVING count(*) > 0""",
    ),
)
def dlq_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that is repeated leaves its rejected rows once; the root's name needs encoding."""
    root = f"{fresh_path(spark, 'quarantine')}/all of it"
    refused = rejected_rows(_cleaned(spark, sf_dir), CUSTOMER_RULES)
    for _ in range(2):
        write_quarantine(refused, root, "silver", "my customers", RUN_2, THIRD_LOAD)
    return quarantine_summary(spark, root)


# ---- current state and history -----------------------------------------


def _text(column: str) -> str:
    return f"coalesce(CAST(length({column}) AS STRING) || ':' || {column}, '~')"


def hash_sql(columns: list[str]) -> str:
    return f"sha256(concat_ws('|', {', '.join(_text(c) for c in columns)}))"


def initial_sql(source: str, as_of: str, tracked: list[str] = TRACKED) -> str:
    return (
        f"SELECT *, {hash_sql(tracked)} AS _hash_key, TRUE AS _is_current, TIMESTAMP '{as_of}' AS _valid_from, "
        f"CAST(NULL AS TIMESTAMP) AS _valid_to FROM {source}"
    )


def changed_sql(target: str, source: str, tracked: list[str] = TRACKED) -> str:
    differs = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in tracked)
    return (
        f"SELECT DISTINCT t.customer_id FROM {target} t JOIN {source} s ON t.customer_id = s.customer_id "
        f"WHERE t._is_current AND ({differs})"
    )


def expired_sql(target: str, source: str, as_of: str, tracked: list[str] = TRACKED) -> str:
    return (
        f"SELECT * REPLACE (FALSE AS _is_current, TIMESTAMP '{as_of}' AS _valid_to) FROM {target} "
        f"WHERE _is_current AND customer_id IN ({changed_sql(target, source, tracked)})"
    )


def new_sql(target: str, source: str, as_of: str, tracked: list[str] = TRACKED) -> str:
    unseen = (
        f"(SELECT * FROM {source} s WHERE NOT EXISTS "
        f"(SELECT 1 FROM {target} t WHERE t._is_current AND t.customer_id = s.customer_id))"
    )
    return initial_sql(unseen, as_of, tracked)


def apply_sql(target: str, source: str, as_of: str, tracked: list[str] = TRACKED) -> str:
    changed = changed_sql(target, source, tracked)
    versions = initial_sql(f"(SELECT * FROM {source} WHERE customer_id IN ({changed}))", as_of, tracked)
    return (
        f"SELECT * FROM {target} WHERE NOT (_is_current AND customer_id IN ({changed})) "
        f"UNION ALL {expired_sql(target, source, as_of, tracked)} "
        f"UNION ALL {versions} UNION ALL {new_sql(target, source, as_of, tracked)}"
    )


_PROFILE = "customer_id, email, customer_type, status, last_order_id"


def _profile_sql(name: str) -> str:
    latest = latest_sql(name, "customer_id", "last_order_date DESC, last_order_id DESC")
    return f"SELECT {_PROFILE} FROM ({latest})"


_PROFILES = ["profile_1", "profile_2", "profile_3", "profile_later", "profile_all"]
_HISTORY = f"""
p1 AS ({_profile_sql('profile_1')}), p2 AS ({_profile_sql('profile_2')}), p3 AS ({_profile_sql('profile_3')}),
later AS ({_profile_sql('profile_later')}), whole AS ({_profile_sql('profile_all')}),
h1 AS ({initial_sql('p1', FIRST_LOAD)}),
h2 AS ({apply_sql('h1', 'p2', SECOND_LOAD)})
"""


def _profile(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    newest = latest_per_key(frame(spark, sf_dir, name), KEY, NEWEST)
    return newest.select(*[c.strip() for c in _PROFILE.split(",")])


def _history_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_initial(_profile(spark, sf_dir, "profile_1"), TRACKED, FIRST_LOAD)


def _history_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As in a run of loads, the next load finds a stored table.
    target = stored(_history_1(spark, sf_dir), "history")
    state = scd2_apply(target, _profile(spark, sf_dir, "profile_2"), KEY, TRACKED, SECOND_LOAD)
    return stored(state, "history")


@query(
    "row_hash",
    f"""SELECT o_orderkey, {hash_sql(['o_orderstatus', 'o_orderpriority', 'CAST(o_custkey AS STRING)'])}
        AS _hash_key FROM (SELECT o_orderkey, o_custkey, o_orderstatus,
        nullif(o_orderpriority, '3-MEDIUM') AS o_orderpriority FROM orders)""",
)
def hash_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "o_orderstatus", "nullif(o_orderpriority, '3-MEDIUM') AS o_orderpriority"
    )
    return orders.select("o_orderkey", row_hash(orders, ["o_orderstatus", "o_orderpriority", "o_custkey"]).alias("_hash_key"))


@query(
    "scd1_upsert",
    with_inputs(
        _PROFILES,
        _HISTORY,
        """SELECT * FROM p1 WHERE customer_id NOT IN (SELECT customer_id FROM later)
           UNION ALL SELECT * FROM later""",
    ),
)
def scd1_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = stored(_profile(spark, sf_dir, "profile_1"), "profile")
    return upsert(target, stored(_profile(spark, sf_dir, "profile_later"), "profile"), KEY)


@query("scd2_initial", with_inputs(_PROFILES, _HISTORY, initial_sql("whole", FIRST_LOAD)))
def history_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_initial(_profile(spark, sf_dir, "profile_all"), TRACKED, FIRST_LOAD)


@query("scd2_changed_keys", with_inputs(_PROFILES, _HISTORY, changed_sql("h2", "p3")))
def history_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_changed_keys(_history_2(spark, sf_dir), _profile(spark, sf_dir, "profile_3"), KEY, TRACKED)


@query("scd2_new_rows", with_inputs(_PROFILES, _HISTORY, new_sql("h1", "later", SECOND_LOAD)))
def history_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = stored(_history_1(spark, sf_dir), "history")
    return scd2_new_rows(target, _profile(spark, sf_dir, "profile_later"), KEY, TRACKED, SECOND_LOAD)


@query("scd2_expired_rows", with_inputs(_PROFILES, _HISTORY, expired_sql("h2", "p3", THIRD_LOAD)))
def history_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_expired_rows(
        _history_2(spark, sf_dir), _profile(spark, sf_dir, "profile_3"), KEY, TRACKED, THIRD_LOAD
    )


@query("scd2_apply", with_inputs(_PROFILES, _HISTORY, apply_sql("h2", "p3", THIRD_LOAD)))
def history_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = stored(_profile(spark, sf_dir, "profile_3"), "batch")
    return scd2_apply(_history_2(spark, sf_dir), source, KEY, TRACKED, THIRD_LOAD)


@query("scd2_apply_small_source", with_inputs(_PROFILES, _HISTORY, apply_sql("h2", "p3", THIRD_LOAD)))
def history_apply_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _history_2(spark, sf_dir)
    source = stored(_profile(spark, sf_dir, "profile_3"), "batch")
    return scd2_apply(state, source, KEY, TRACKED, THIRD_LOAD, small_source=True)


@query("scd2_apply_stored", with_inputs(_PROFILES, _HISTORY, apply_sql("h2", "p3", THIRD_LOAD)))
def history_apply_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads into a history in two parts: closed versions are added, and only folders whose
    keys change are written again."""
    root = fresh_path(spark, "history")
    start_history(_history_1(spark, sf_dir), KEY, root, 32)
    for version, (name, as_of) in enumerate((("profile_2", SECOND_LOAD), ("profile_3", THIRD_LOAD)), 2):
        state = load_history(_profile(spark, sf_dir, name), KEY, TRACKED, root, version, as_of)
    return state.drop(BUCKET)


@query(
    "scd2_current",
    with_inputs(
        _PROFILES, _HISTORY, f"SELECT * FROM ({apply_sql('h2', 'p3', THIRD_LOAD)}) WHERE _is_current"
    ),
)
def history_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_rows(history_apply(spark, sf_dir))


CUSTOMER_TABLE = TableConfig("customers", ("customer_id",), 2, ("status", "customer_type", "email"))


def _stamped(source: str, run: str, as_of: str) -> str:
    return (
        f"(SELECT {_ROW}, '{run}' AS _pipeline_run_id, TIMESTAMP '{as_of}' AS _load_timestamp FROM {source})"
    )


@query(
    "silver_transform",
    with_inputs(
        ["raw_customers", "earlier_customers"],
        f"""{_CHECKED},
            target AS ({initial_sql(_stamped('earlier_customers', RUN_1, FIRST_LOAD), FIRST_LOAD, list(CUSTOMER_TABLE.tracked))}),
            valid AS (SELECT {_ROW} FROM checked WHERE n1 AND f1 AND v1),
            loaded AS {_stamped('valid', RUN_2, AS_OF_DAY)}""",
        apply_sql("target", "loaded", AS_OF_DAY, list(CUSTOMER_TABLE.tracked)),
    ),
)
def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    earlier = with_audit(
        frame(spark, sf_dir, "earlier_customers"), RUN_1, {"_load_timestamp": FIRST_LOAD}
    )
    target = scd2_initial(earlier, CUSTOMER_TABLE.tracked, FIRST_LOAD)
    source = frame(spark, sf_dir, "raw_customers")
    return silver_transform(source, target, CUSTOMER_TABLE, CUSTOMER_RULES, RUN_2, AS_OF_DAY).state


@query(
    "silver_load_metrics",
    with_inputs(
        ["raw_customers"],
        _CHECKED,
        f"""SELECT count(*) AS records_read, count(*) FILTER (WHERE n1 AND f1 AND v1) AS records_written,
                   count(*) FILTER (WHERE NOT (n1 AND f1 AND v1)) AS records_quarantined,
                   '{RUN_2}' AS pipeline_run_id, 'customers' AS table_name FROM checked""",
    ),
)
def silver_load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load with its writes: staging, next version, quarantine; its metrics row."""
    root = fresh_path(spark, "conformed")
    return run_silver(
        frame(spark, sf_dir, "raw_customers"),
        None,
        CUSTOMER_TABLE,
        CUSTOMER_RULES,
        root,
        1,
        RUN_2,
        AS_OF_DAY,
        f"{root}-quarantine",
    )


@query(
    "silver_by_day",
    with_inputs(
        ["profile_1"],
        f"""p1 AS ({latest_sql('profile_1', 'customer_id', 'last_order_date DESC, last_order_id DESC')})""",
        f"""SELECT customer_id, status, last_order_id, last_order_date, '{RUN_1}' AS _pipeline_run_id,
                   TIMESTAMP '{FIRST_LOAD}' AS _load_timestamp FROM p1""",
    ),
)
def silver_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load whose settings ask for folders by a time: one per day."""
    root = fresh_path(spark, "conformed")
    config = TableConfig("customers", ("customer_id",), 1, partition_by=("last_order_date",))
    newest = latest_per_key(frame(spark, sf_dir, "profile_1"), KEY, NEWEST)
    source = newest.select("customer_id", "status", "last_order_id", "last_order_date")
    run_silver(source, None, config, [], root, 1, RUN_1, FIRST_LOAD, f"{root}-quarantine")
    return read_snapshot(spark, f"{root}/customers", 1).drop("last_order_date_day")
