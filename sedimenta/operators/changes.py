"""Change rows: decode, latest per key, apply to a table.

Every function returns a DataFrame and runs nothing.  Keys compare with plain
equality, so a row with a NULL key matches nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.functions.columns import DELETE, UPDATE_BEFORE, decode_operation, moment
from sedimenta.operators.merge import merge_rows


def decode_changes(changes: DataFrame, code: str = "_cdc_operation_code") -> DataFrame:
    """Name each operation and drop before-images."""
    return changes.withColumn("_cdc_operation", decode_operation(code)).filter(
        F.col("_cdc_operation") != UPDATE_BEFORE
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` tuple of each key.

    Written as ``row_number() = 1``: Spark then keeps one row per key on the
    map side already (``WindowGroupLimit``), so a key that holds a third of all
    rows reaches the shuffle as one row per input partition.
    Give enough ``order_by`` columns to make the order total.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order_by])
    return df.withColumn("_rank", F.row_number().over(newest_first)).filter(F.col("_rank") == 1).drop("_rank")


def data_columns(df: DataFrame) -> list[str]:
    """Columns that are data: metadata starts with ``_`` (which covers ``__$``)."""
    return [c for c in df.columns if not c.startswith("_")]


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    run_id: str,
    as_of: Column | dt.datetime | str,
    order_by: Sequence[str] = ("_cdc_version", "_cdc_seq"),
    code: str = "_cdc_operation_code",
) -> DataFrame:
    """Next state of ``target`` after a batch of change rows.

    Per key the latest change wins: DELETE removes, anything else writes the
    row.  The target is read once and shuffled at most once; of the batch the
    anti join sees the distinct keys only.
    """
    decoded = decode_changes(changes, code)
    stamp_type = target.schema["_ingest_timestamp"].dataType if "_ingest_timestamp" in target.columns else None
    written = (
        latest_per_key(decoded, keys, order_by)
        .filter(F.col("_cdc_operation") != DELETE)
        .select(
            *data_columns(changes),
            F.col("_cdc_operation"),
            F.lit(run_id).alias("_pipeline_run_id"),
            moment(as_of, stamp_type).alias("_ingest_timestamp"),
        )
    )
    return merge_rows(target, written, keys, touched=decoded.select(*keys).distinct())


def positions(order_by: Sequence[str]) -> list[str]:
    """Columns in which a guarded state keeps the position last applied to a key."""
    return [f"_applied{c}" for c in order_by]


def positions_of(alias: str, order_by: Sequence[str]) -> Column:
    """That position as one value; one without a value is before all others."""
    return F.struct(*[F.col(f"{alias}.`{c}`") for c in positions(order_by)])


def newer_changes(
    changes: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    code: str,
    run_id: str,
    as_of: Column | dt.datetime | str,
) -> DataFrame:
    """The latest change of each key as a row of a guarded state: with its position, and for a
    DELETE with the keys alone."""
    latest = latest_per_key(decode_changes(changes, code), keys, order_by)
    deleted = F.col("_cdc_operation") == DELETE
    data = [F.col(c) if c in keys else F.when(~deleted, F.col(c)).alias(c) for c in data_columns(changes)]
    return latest.select(
        *data,
        "_cdc_operation",
        F.lit(run_id).alias("_pipeline_run_id"),
        moment(as_of).alias("_ingest_timestamp"),
        *[F.col(c).cast("long").alias(p) for c, p in zip(order_by, positions(order_by), strict=True)],
        deleted.alias("_deleted"),
    )


def high_water_mark(df: DataFrame, position: str = "_cdc_version") -> DataFrame:
    """One row: the greatest applied position, NULL for no rows."""
    return df.agg(F.max(position).alias("high_water_mark"))


def duplicate_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Keys that occur more than once, with their row count.  NULL keys do not count."""
    keys = list(keys)
    return (
        df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")
    )


def require_unique(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """``df`` itself, after checking that no key occurs twice (reads the key columns once)."""
    keys = list(keys)
    clash = duplicate_keys(df, keys).first()
    if clash is not None:
        shown = ", ".join(f"{k}={clash[k]!r}" for k in keys)
        raise ValueError(f"{clash['row_count']} source rows share one key ({shown}); keep one row per key first")
    return df
