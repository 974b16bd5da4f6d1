"""Conformed layer: clean, check, keep current state or history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.config import Rule, TableConfig
from sedimenta.functions.columns import with_audit
from sedimenta.functions.strings import clean_strings
from sedimenta.operators.changes import require_unique
from sedimenta.operators.history import scd2_apply, scd2_initial
from sedimenta.operators.merge import upsert
from sedimenta.operators.quality import (
    load_metrics,
    orphan_rows,
    rejected_rows,
    stop_on_error,
    tag_rows,
    valid_rows,
)
from sedimenta.plans.replay import write_exception_log
from sedimenta.sinks.buckets import load_history, start_history
from sedimenta.sinks.tables import write_quarantine, write_snapshot
from sedimenta.sources.tables import read_path


@dataclass(frozen=True)
class SilverLoad:
    """What one load yields: the next state and the rows it turned away."""

    state: DataFrame
    rejected: DataFrame


def _next_state(
    valid: DataFrame,
    target: DataFrame | None,
    config: TableConfig,
    run_id: str,
    as_of: Column | dt.datetime | str,
    small_source: bool = False,
) -> DataFrame:
    loaded = with_audit(valid, run_id, {"_load_timestamp": as_of})
    if config.scd_type == 2:
        return scd2_apply(target, loaded, config.keys, config.tracked, as_of, small_source)
    return upsert(target, loaded, config.keys)


def silver_transform(
    source: DataFrame,
    target: DataFrame | None,
    config: TableConfig,
    rules: Sequence[Rule],
    run_id: str,
    as_of: Column | dt.datetime | str,
    parents: Mapping[str, DataFrame] | None = None,
    on_error: str = "reject",
) -> SilverLoad:
    """Clean strings, apply the rules, merge the valid rows into the target.

    ``on_error="fail"`` stops the job at the first row that breaks an ERROR
    rule; the default rejects the row.
    """
    if on_error not in ("reject", "fail"):
        raise ValueError("on_error must be 'reject' or 'fail'")
    cleaned = clean_strings(source)
    if on_error == "fail":
        cleaned = stop_on_error(cleaned, rules, parents)
    valid = valid_rows(cleaned, rules, parents)
    return SilverLoad(
        state=_next_state(valid, target, config, run_id, as_of),
        rejected=rejected_rows(cleaned, rules, parents),
    )


def run_silver(
    source: DataFrame,
    target: DataFrame | None,
    config: TableConfig,
    rules: Sequence[Rule],
    root: str,
    version: int,
    run_id: str,
    as_of: Column | dt.datetime | str,
    quarantine_root: str,
    parents: Mapping[str, DataFrame] | None = None,
    on_error: str = "reject",
    small_source: bool = False,
    buckets: int | None = None,
    log_root: str | None = None,
) -> DataFrame:
    """One load end to end; returns its metrics row.

    The source is cleaned and tagged once and staged, split by outcome.  The
    merge, the quarantine and the metrics all read those files, so none of them
    repeats the source scan, the rules or the parent joins.  ``small_source`` is
    passed on to the history merge.

    With ``log_root`` the rejections by rule are logged there, for
    :func:`sedimenta.plans.replay.replay_quarantine` and reports.  With ``buckets`` a history is kept in two parts (see
    :func:`sedimenta.sinks.buckets.start_history`): the load goes on from the version before
    in ``root``, whatever ``target`` is, and writes only folders in which a version opens.
    """
    if buckets and (config.scd_type != 2 or config.partition_by or config.cluster_by):
        raise ValueError("only a history without a layout of its own is kept in buckets")
    spark = source.sparkSession
    cleaned = clean_strings(source)
    if on_error == "fail":
        cleaned = stop_on_error(cleaned, rules, parents)
    staged = f"{root.rstrip('/')}/staging/{config.name}/{run_id}"
    tagged = tag_rows(cleaned, rules, parents)
    tagged.write.mode("overwrite").partitionBy("_accepted").parquet(staged)
    tagged = read_path(spark, staged, tagged.schema)
    accepted = tagged.filter("_accepted").select(*cleaned.columns)
    refused = tagged.filter("NOT _accepted").select(*cleaned.columns, "_failed_rules")

    require_unique(accepted, config.keys)
    # Quarantine first: a run that fails in between is simply run again.
    place = write_quarantine(refused, quarantine_root, "silver", config.name, run_id, as_of)
    if log_root is not None:
        write_exception_log(refused, log_root, config.name, run_id, place, as_of)
    if buckets:
        loaded, place = with_audit(accepted, run_id, {"_load_timestamp": as_of}), f"{root}/{config.name}"
        if version == 1:
            start_history(scd2_initial(loaded, config.tracked, as_of), config.keys, place, buckets)
        else:
            load_history(loaded, config.keys, config.tracked, place, version, as_of)
    else:
        state = _next_state(accepted, target, config, run_id, as_of, small_source)
        write_snapshot(state, f"{root}/{config.name}", version, config.partition_by, config.cluster_by)
    return load_metrics(tagged, run_id).withColumn("table_name", F.lit(config.name))


def run_reference_audit(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    parent_column: str,
    rule_id: str,
    report: Sequence[str],
    table: str,
    run_id: str,
    as_of: Column | dt.datetime | str,
    quarantine_root: str,
) -> str:
    """After the load: write the ``report`` columns of orphaned rows, tagged with the rule.

    One job; no orphans leave no lines.  Returns the folder, which
    ``quarantine_summary`` counts.
    """
    orphans = orphan_rows(child, column, parent, parent_column, rule_id).select(*report, "rule_id")
    return write_quarantine(orphans, quarantine_root, "audit", table, run_id, as_of)
