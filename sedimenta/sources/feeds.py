"""Incremental reads: change rows after a position, rows after a watermark."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _column(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def changes_after(
    changes: DataFrame,
    last: Any = None,
    position: str = "_cdc_version",
    since: Any = None,
    until: Any = None,
    time: str = "_change_timestamp",
) -> DataFrame:
    """Change rows behind ``last`` (all of them for None), optionally within a time window.

    Bounds may be values or scalar subqueries; as plain comparisons they reach
    the scan.
    """
    if last is not None:
        changes = changes.filter(F.col(position) > _column(last))
    if since is not None:
        changes = changes.filter(F.col(time) >= _column(since))
    if until is not None:
        changes = changes.filter(F.col(time) <= _column(until))
    return changes


def in_log_order(changes: DataFrame, *order_by: str) -> DataFrame:
    """Ascending by position: a range-partitioned sort, no single task sees everything."""
    return changes.orderBy(*(order_by or ("_cdc_version", "_cdc_seq")))


def rows_after_watermark(df: DataFrame, column: str, last: Any = None) -> DataFrame:
    """Rows at or behind the last greatest value of ``column``.

    Rows that arrive late with that very value are read as well; the load is an
    upsert, so reading a row twice changes nothing.  Rows without a value have no
    place before or after and are read every time.
    """
    if last is None:
        return df
    return df.filter((F.col(column) >= _column(last)) | F.col(column).isNull())
