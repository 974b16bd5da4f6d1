"""Row rules, table rules and referential audits.

A rule that evaluates to NULL has failed: every row is either valid or
rejected, never lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType

from sedimenta.config import ERROR, REF_INTEGRITY, WARNING, Rule, active
from sedimenta.functions.columns import all_present


def _parent_flag(rule: Rule) -> str:
    return f"_parent_{rule.rule_id}"


def _holds(rule: Rule) -> Column:
    """The rule as a column; NULL counts as failed only once coalesced."""
    if rule.rule_type == REF_INTEGRITY:
        return F.col(f"`{_parent_flag(rule)}`")
    return F.expr(rule.expression)


def _passed(rule: Rule) -> Column:
    return F.coalesce(_holds(rule), F.lit(False))


def _all(tests: Iterable[Column]) -> Column:
    return reduce(and_, tests, F.lit(True))


def with_parent_flag(
    df: DataFrame, column: str, parent: DataFrame, parent_column: str, flag: str
) -> DataFrame:
    """Mark the rows whose ``column`` occurs in the parent.  NULL does not occur.

    The parent is reduced to its distinct keys first, so rows never multiply.
    """
    known = parent.select(F.col(parent_column).alias("_key")).dropna().distinct()
    match = df[column] == F.col("_key")
    if df.schema[column].dataType == known.schema["_key"].dataType and not isinstance(
        df.schema[column].dataType, FractionalType
    ):
        # Adaptive execution splits a hot child key only where both join inputs
        # come straight from a shuffle.  The distinct keys would not: they are
        # already placed by key.  A second, implied condition makes Spark place
        # them again (keys only), which leaves the child's partitions splittable.
        match = match & (F.xxhash64(df[column]) == F.xxhash64(F.col("_key")))
    return df.join(known, match, "left").withColumn(flag, F.col("_key").isNotNull()).drop("_key")


def _with_parents(df: DataFrame, rules: Sequence[Rule], parents: Mapping[str, DataFrame]) -> DataFrame:
    for rule in rules:
        if rule.rule_type == REF_INTEGRITY:
            df = with_parent_flag(
                df, rule.column_name, parents[rule.parent], rule.parent_column, _parent_flag(rule)
            )
    return df


def _ids(rules: Sequence[Rule]) -> Column:
    """Ids of the failed rules, in rule order."""
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(~_passed(r), F.lit(r.rule_id)) for r in rules]))


def tag_rows(
    df: DataFrame, rules: Sequence[Rule], parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Add ``_failed_rules``, ``_warnings`` (arrays of rule ids) and ``_accepted``."""
    rules = active(rules)
    rejecting = [r for r in rules if r.rejects]
    warning = [r for r in rules if r.severity == WARNING]
    tagged = _with_parents(df, rules, parents or {})
    return tagged.select(
        *df.columns,
        _ids(rejecting).alias("_failed_rules"),
        _ids(warning).alias("_warnings"),
        _all(_passed(r) for r in rejecting).alias("_accepted"),
    )


def valid_rows(
    df: DataFrame, rules: Sequence[Rule], parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Rows that pass every rejecting rule.

    The rules stay plain conjuncts (a filter drops NULL as it drops false), so
    they reach the file scan.
    """
    rejecting = [r for r in active(rules) if r.rejects]
    flagged = _with_parents(df, rejecting, parents or {})
    return flagged.filter(_all(_holds(r) for r in rejecting)).select(*df.columns)


def rejected_rows(
    df: DataFrame, rules: Sequence[Rule], parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Rows that fail a rejecting rule, with ``_failed_rules``."""
    rejecting = [r for r in active(rules) if r.rejects]
    flagged = _with_parents(df, rejecting, parents or {})
    return flagged.filter(~_all(_passed(r) for r in rejecting)).select(
        *df.columns, _ids(rejecting).alias("_failed_rules")
    )


def warned_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Valid rows that fail a warning rule, with ``_warnings``; they are kept by the load."""
    warning = [r for r in active(rules) if r.severity == WARNING]
    return (
        valid_rows(df, rules)
        .filter(~_all(_passed(r) for r in warning))
        .withColumn("_warnings", _ids(warning))
    )


def stop_on_error(
    df: DataFrame, rules: Sequence[Rule], parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """``df`` itself; the job that reads it fails at the first row that breaks an ERROR rule."""
    fatal = [r for r in active(rules) if r.severity == ERROR]
    if not fatal:
        return df
    flagged = _with_parents(df, fatal, parents or {})
    text = F.concat(F.lit("row breaks rules: "), F.concat_ws(",", _ids(fatal)))
    stop = F.raise_error(text).cast("boolean")
    passed = _all(_passed(r) for r in fatal)
    return flagged.filter(F.when(passed, F.lit(True)).otherwise(stop)).select(*df.columns)


def exception_summary(rejected: DataFrame, run_id: str) -> DataFrame:
    """Rejections per rule.  A row failing two rules counts under both."""
    return (
        rejected.select(F.explode("_failed_rules").alias("rule_id"))
        .groupBy("rule_id")
        .agg(F.count(F.lit(1)).alias("exception_count"))
        .select(F.lit(run_id).alias("pipeline_run_id"), "rule_id", "exception_count")
    )


def load_metrics(tagged: DataFrame, run_id: str) -> DataFrame:
    """One row: records read, written and quarantined, from one pass over the tags."""
    return tagged.agg(
        F.count(F.lit(1)).alias("records_read"),
        F.count_if("_accepted").alias("records_written"),
        F.count_if(~F.col("_accepted")).alias("records_quarantined"),
    ).withColumn("pipeline_run_id", F.lit(run_id))


def table_rules(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """RowCount, IsComplete and Uniqueness of a key: one row per rule.

    Uniqueness is the share of rows whose key occurs exactly once.  Counting
    per key first leaves one row per key and task, so a hot key is no burden.
    """
    keys = list(keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    present = all_present(keys)
    totals = per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("double").alias("total"),
        F.coalesce(F.sum(F.when(present, F.col("_rows"))), F.lit(0)).cast("double").alias("complete"),
        F.count_if(present & (F.col("_rows") == 1)).cast("double").alias("once"),
    )
    share = lambda n: F.when(F.col("total") > 0, F.col(n) / F.col("total"))

    def outcome(rule: str, value: Column, passed: Column) -> Column:
        return F.struct(
            F.lit(rule).alias("rule"),
            value.alias("value"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )

    return totals.select(
        F.inline(
            F.array(
                outcome("RowCount", F.col("total"), F.col("total") > 0),
                outcome("IsComplete", share("complete"), F.col("complete") == F.col("total")),
                outcome("Uniqueness", share("once"), F.col("once") == F.col("total")),
            )
        )
    )


def orphan_rows(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, rule_id: str
) -> DataFrame:
    """Child rows whose parent is missing (a NULL reference counts), tagged with the rule id."""
    known = parent.select(F.col(parent_column).alias("_key"))
    return child.join(known, child[column] == F.col("_key"), "left_anti").withColumn(
        "rule_id", F.lit(rule_id)
    )
