"""Writes of single partitions: a load adds what it changes and a manifest that names the rest."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sedimenta.operators.merge import merge_rows, replace_where, touched_partitions, unique_rows
from sedimenta.session import stored
from sedimenta.sinks.layout import by_partition
from sedimenta.sources.tables import read_snapshot
from sedimenta.sources.versions import (
    NO_VALUE,
    is_complete,
    make_folder,
    manifest_path,
    partition_folders,
    partition_names,
    partition_places,
    read_places,
    snapshot_path,
    without,
)


def write_manifest(
    spark: SparkSession, root: str, version: int, places: Mapping[str, int], schema: StructType
) -> None:
    """One row per partition, and one that holds the schema; a single small file."""
    head = ("", None, json.dumps(schema.jsonValue()))
    rows = [head, *((part, at, None) for part, at in sorted(places.items()))]
    table = spark.createDataFrame(rows, "part string, version int, schema string").coalesce(1)
    table.write.mode("overwrite").parquet(manifest_path(root, version))


def write_partitions(
    df: DataFrame,
    root: str,
    version: int,
    partition_by: Sequence[str],
    replacing: Iterable[str] = (),
    base: int | None = None,
) -> DataFrame:
    """Write ``df`` as partitions of a new version; all others stay those of ``base``.

    ``replacing`` names partitions (``day=20240101``) that ``df`` stands for: those it has
    no rows of are dropped.  A partition it writes replaces that of ``base``.  Returns the
    whole version.

    The version counts from its manifest on, which is written last.  A load that failed
    before is run again and writes all anew; one that got so far is left as it is, so
    any load may be repeated.
    """
    spark = df.sparkSession
    if not is_complete(spark, manifest_path(root, version)):
        before = partition_places(spark, root, base) if base is not None else {}
        if "" in before:
            raise ValueError(f"version {base} of {root} is not partitioned")
        folder = snapshot_path(root, version)
        make_folder(spark, manifest_path(root, version))  # from now on no reader takes the folder for the table
        by_partition(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(folder)
        places = without(before, replacing) | dict.fromkeys(partition_folders(spark, folder), version)
        write_manifest(spark, root, version, places, df.schema)
    return read_snapshot(spark, root, version, df.schema)


def upsert_version(
    source: DataFrame,
    keys: Sequence[str],
    partition: str,
    root: str,
    version: int,
    base: int | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Upsert into a partitioned table: only partitions that rows enter or leave are read and written.

    ``base`` is the version before by default.  The source is stored once.  Of
    the table's other partitions only keys are read, to find rows that leave them.  Rows
    without a partition value share a partition of their own.
    """
    spark = source.sparkSession
    base = version - 1 if base is None else base
    if is_complete(spark, manifest_path(root, version)):
        return read_snapshot(spark, root, version, schema)
    target = read_snapshot(spark, root, base, schema)
    source = stored(unique_rows(source.select(*target.columns), keys), "batch")
    # One name per touched partition: a manifest is driver work anyway.
    touched = partition_names(spark, touched_partitions(target, source, keys, partition), [partition])
    places = partition_places(spark, root, base)
    old = read_places(spark, root, {p: at for p, at in places.items() if p in touched}, target.schema)
    return write_partitions(merge_rows(old, source, keys), root, version, [partition], touched, base)


def replace_version(
    new: DataFrame,
    partition: str,
    first: int,
    root: str,
    version: int,
    base: int | None = None,
    without_value: DataFrame | None = None,
    further: tuple[DataFrame, Iterable[str]] | None = None,
) -> DataFrame:
    """Swap all partitions from ``first`` on for ``new``; earlier ones keep their files.

    A new row of an earlier partition stops the job.  Only ``new`` is written, and, if given,
    ``without_value``: all rows that the partition without a value is to hold, and ``further``: all rows
    of some earlier partitions, and their names.
    """
    spark = new.sparkSession
    base = version - 1 if base is None else base
    replacing: list[str] = []
    if not is_complete(spark, manifest_path(root, version)):
        places = partition_places(spark, root, base)
        replacing = [p for p in places if (value := partition_value(p)) is not None and value >= first]
        if without_value is not None:
            replacing.append(f"{partition}={NO_VALUE}")
        replacing += further[1] if further else []
    rows = replace_where(None, new, f"{partition} >= {first}")
    if without_value is not None:
        rows = rows.unionByName(without_value)
    if further:
        rows = rows.unionByName(further[0])
    return write_partitions(rows, root, version, [partition], replacing, base)


def partition_value(part: str) -> int | None:
    """The whole number in the name of a partition by one column; None for one without value."""
    text = part.rpartition("=")[2]
    return int(text) if text.lstrip("-").isdigit() else None

