"""Whole-row cleanup: one projection per call, so one node in the plan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def clean_strings(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Trim every string column (or the listed ones); an empty result becomes NULL."""
    wanted = set(df.columns if columns is None else columns)
    return df.select(
        *[
            F.nullif(F.trim(F.col(f.name)), F.lit("")).alias(f.name)
            if f.name in wanted and isinstance(f.dataType, StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def cast_timestamps(
    df: DataFrame, columns: Iterable[str], to: str = "timestamp", strict: bool = False
) -> DataFrame:
    """Cast the listed columns to a timestamp type.

    Text that is no timestamp becomes NULL, or raises when ``strict``.
    """
    wanted = set(columns)
    return df.select(
        *[
            (F.col(c).cast(to) if strict else F.col(c).try_cast(to)).alias(c) if c in wanted else F.col(c)
            for c in df.columns
        ]
    )
