"""Raw layer: full copy, change apply, watermark load."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.config import CDC, FULL, RawConfig
from sedimenta.functions.columns import DELETE, INITIAL_LOAD, decode_operation, moment
from sedimenta.operators.changes import apply_changes
from sedimenta.operators.merge import upsert
from sedimenta.sinks.buckets import apply_guarded, live_rows, start_guarded
from sedimenta.sinks.tables import write_snapshot, write_staging
from sedimenta.sources.feeds import changes_after, rows_after_watermark
from sedimenta.sources.tables import read_path


@dataclass(frozen=True)
class RawLoad:
    """What a load yields: the next state, and one row on the batch.

    ``metrics`` has ``records_read``, ``records_deleted``, ``high_water_mark`` (from
    which the next load goes on; the mark before, if nothing new came) and
    ``_pipeline_run_id``.
    """

    state: DataFrame
    metrics: DataFrame


def _metrics(batch: DataFrame, position: str, last: Any, run_id: str, deleted: Column) -> DataFrame:
    kind = batch.schema[position].dataType
    before = last if isinstance(last, Column) else F.lit(last)
    return batch.agg(
        F.count(F.lit(1)).alias("records_read"),
        F.count_if(deleted).alias("records_deleted"),
        F.coalesce(F.max(position), before.cast(kind)).alias("high_water_mark"),
    ).withColumn("_pipeline_run_id", F.lit(run_id))


def initial_load(source: DataFrame, run_id: str, as_of: Column | dt.datetime | str) -> DataFrame:
    """Every source row with the load's audit columns."""
    return source.withColumns(
        {
            "_cdc_operation": F.lit(INITIAL_LOAD),
            "_pipeline_run_id": F.lit(run_id),
            "_ingest_timestamp": moment(as_of),
        }
    )


def watermark_load(
    target: DataFrame | None, source: DataFrame, keys: Sequence[str], column: str, last: Any = None
) -> DataFrame:
    """Upsert of the rows newer than the last watermark."""
    return upsert(target, rows_after_watermark(source, column, last), keys)


def run_initial_load(
    source: DataFrame,
    root: str,
    table: str,
    run_id: str,
    as_of: Column | dt.datetime | str,
    cluster_by: Sequence[str] = (),
) -> DataFrame:
    """Stage the copy, then write version 1 from the staged files (the source is read once)."""
    loaded = initial_load(source, run_id, as_of)
    staged = write_staging(loaded, root, table, "initial", run_id)
    copy = read_path(source.sparkSession, staged, loaded.schema)
    return write_snapshot(copy, f"{root}/{table}", 1, cluster_by=cluster_by)


def run_incremental_load(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    root: str,
    table: str,
    version: int,
    run_id: str,
    as_of: Column | dt.datetime | str,
    last: Any = None,
    cluster_by: Sequence[str] = (),
    since: Any = None,
    until: Any = None,
) -> RawLoad:
    """Stage the new change rows, then write the next version.

    Staging comes first, so the merge (which uses the batch twice) and the metrics
    read files and the change feed is queried once.  ``since`` and ``until`` bound
    the changes' time.  ``cluster_by`` (usually the keys) adds
    a range shuffle of the whole table; on large tables do it now and then
    rather than in every load.
    """
    fresh = changes_after(changes, last, since=since, until=until)
    staged = write_staging(fresh, root, table, "incremental", run_id)
    batch = read_path(target.sparkSession, staged, changes.schema)
    state = apply_changes(target, batch, keys, run_id, as_of)
    gone = decode_operation("_cdc_operation_code") == DELETE
    return RawLoad(
        write_snapshot(state, f"{root}/{table}", version, cluster_by=cluster_by),
        _metrics(batch, "_cdc_version", last, run_id, gone),
    )


#: Columns that tell the position of a change row.
_POSITION = ("_cdc_version", "_cdc_seq")


def run_bucket_copy(
    source: DataFrame,
    keys: Sequence[str],
    root: str,
    table: str,
    buckets: int,
    run_id: str,
    as_of: Column | dt.datetime | str,
    at: Sequence[Any] | None = None,
    version: int = 1,
) -> DataFrame:
    """Full copy into ``buckets`` key-hash folders, to which :func:`run_bucket_load` applies changes.

    ``at`` is the log position of the copy, if known: changes up to it are in the copy.
    """
    loaded = initial_load(source, run_id, as_of)
    staged = read_path(source.sparkSession, write_staging(loaded, root, table, "initial", run_id), loaded.schema)
    return live_rows(start_guarded(staged, keys, f"{root}/{table}", buckets, _POSITION, at, version), _POSITION)


def run_bucket_load(
    changes: DataFrame,
    keys: Sequence[str],
    root: str,
    table: str,
    version: int,
    run_id: str,
    as_of: Column | dt.datetime | str,
    last: Any = None,
    since: Any = None,
    until: Any = None,
) -> RawLoad:
    """Stage the change rows, then write the next version of a table in key-hash folders.

    Only folders in which a key changes are written.  Every key knows the position last applied to
    it, so windows (``since``, ``until``) may overlap, and a load may come late or twice.
    """
    fresh = changes_after(changes, last, since=since, until=until)
    staged = write_staging(fresh, root, table, "incremental", run_id)
    batch = read_path(changes.sparkSession, staged, changes.schema).drop("_change_timestamp")
    state = apply_guarded(batch, keys, f"{root}/{table}", version, run_id, as_of, _POSITION)
    gone = decode_operation("_cdc_operation_code") == DELETE
    return RawLoad(live_rows(state, _POSITION), _metrics(batch, "_cdc_version", last, run_id, gone))


def run_watermark_load(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    column: str,
    root: str,
    table: str,
    version: int,
    run_id: str,
    last: Any = None,
    cluster_by: Sequence[str] = (),
) -> RawLoad:
    """Stage the rows at or behind the watermark, then write the next version."""
    staged = write_staging(rows_after_watermark(source, column, last), root, table, "watermark", run_id)
    batch = read_path(source.sparkSession, staged, source.schema)
    return RawLoad(
        write_snapshot(upsert(target, batch, keys), f"{root}/{table}", version, cluster_by=cluster_by),
        _metrics(batch, column, last, run_id, F.lit(False)),
    )


def run_raw_load(
    config: RawConfig,
    source: DataFrame,
    target: DataFrame | None,
    root: str,
    version: int,
    run_id: str,
    as_of: Column | dt.datetime | str,
    buckets: int | None = None,
) -> RawLoad:
    """The load that a settings row asks for.

    A full copy where the setting says so or no load is complete yet; else changes
    behind the last position, or rows at or behind the last watermark.  With ``buckets`` a
    table that follows changes is kept in so many key-hash folders, of which a load writes
    those it changes.
    """
    full = config.load_type == FULL or (config.load_type == CDC and (target is None or not config.initial_load_completed))
    if full:
        loaded = initial_load(source, run_id, as_of)
        staged = read_path(
            source.sparkSession, write_staging(loaded, root, config.name, "initial", run_id), loaded.schema
        )
        marked = config.load_type != CDC and config.watermark in source.columns
        position = source.schema[config.watermark].dataType if marked else "long"
        metrics = staged.agg(F.count(F.lit(1)).alias("records_read")).select(
            "records_read",
            F.lit(0).cast("long").alias("records_deleted"),
            F.lit(config.last).cast(position).alias("high_water_mark"),
            F.lit(run_id).alias("_pipeline_run_id"),
        )
        if buckets and config.load_type == CDC:
            state = start_guarded(staged, config.keys, f"{root}/{config.name}", buckets, _POSITION, version=version)
            return RawLoad(live_rows(state, _POSITION), metrics)
        return RawLoad(write_snapshot(staged, f"{root}/{config.name}", version, cluster_by=config.cluster_by), metrics)
    if config.load_type == CDC and buckets:
        return run_bucket_load(source, config.keys, root, config.name, version, run_id, as_of, config.last)
    if config.load_type == CDC:
        return run_incremental_load(
            target, source, config.keys, root, config.name, version, run_id, as_of, config.last, config.cluster_by
        )
    return run_watermark_load(
        target, source, config.keys, config.watermark, root, config.name, version, run_id, config.last, config.cluster_by
    )
