"""Reads of stored tables, generated dates and quarantined rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sedimenta.sources.versions import has_manifest, read_version, snapshot_path

__all__ = [
    "date_range",
    "dates_between",
    "quarantine_summary",
    "read_path",
    "read_snapshot",
    "snapshot_path",
]


def read_path(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_snapshot(
    spark: SparkSession, root: str, version: int, schema: StructType | None = None
) -> DataFrame:
    """The table as of a version (an older one is time travel).

    With a schema no file is opened to infer one, and the values of partition
    folders keep their declared type.  A version with a manifest is read through it.
    """
    if has_manifest(spark, root, version):
        return read_version(spark, root, version, schema)
    return read_path(spark, snapshot_path(root, version), schema)


def dates_between(bounds: DataFrame, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """One row per day from ``first`` to ``last`` inclusive, from a one-row frame."""
    return bounds.select(
        F.explode(F.sequence(F.col(first).cast("date"), F.col(last).cast("date"), F.expr("INTERVAL 1 DAY"))).alias(
            "full_date"
        )
    )


def date_range(spark: SparkSession, first: dt.date | str, last: dt.date | str) -> DataFrame:
    day = lambda d: F.lit(str(d)).cast("date")
    return dates_between(spark.range(1).select(day(first).alias("first_day"), day(last).alias("last_day")))


def quarantine_summary(spark: SparkSession, root: str) -> DataFrame:
    """Quarantined rows per layer, table and run, all taken from the file paths.

    Files hold one row per line, so lines are counted without parsing them.  Parts
    are counted from the path's end and decoded, whatever the root looks like.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(root.rstrip("/"))
    parts = F.split(F.col("_metadata.file_path"), "/")

    def part(from_end: int) -> Column:
        return F.url_decode(F.replace(F.element_at(parts, -from_end), F.lit("+"), F.lit("%2B")))

    return (
        lines.select(part(4).alias("layer"), part(3).alias("table_name"), part(2).alias("run_id"))
        .groupBy("layer", "table_name", "run_id")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
