"""Writes.  Each state of a table goes to a folder of its own, never over the one being read.

One writer per table at a time; readers are pointed at the new folder by
:func:`publish` once it is complete.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType, TimestampType

from sedimenta.functions.columns import with_audit
from sedimenta.operators.merge import replace_where
from sedimenta.session import stored
from sedimenta.sinks.layout import by_partition, clustered
from sedimenta.sinks.partitions import partition_value, replace_version, upsert_version
from sedimenta.sources.tables import read_snapshot, snapshot_path
from sedimenta.sources.versions import (
    NO_VALUE,
    changed_partitions,
    folder_of,
    has_manifest,
    is_complete,
    manifest_path,
    manifest_schema,
    partition_places,
    remove_folder,
)

#: Partitions that one statement adds.
_TOGETHER = 1000


def write_staging(df: DataFrame, root: str, table: str, mode: str, run_id: str) -> str:
    """A run's own copy of its batch; a re-run replaces it.  Returns the folder."""
    path = f"{root.rstrip('/')}/staging/{table}/{mode}/{run_id}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_snapshot(
    df: DataFrame,
    root: str,
    version: int,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> DataFrame:
    """Write a full state as a new version, with its own schema, and read it back.

    A folder without its success marker is what a failed write left: it counts as
    absent and is replaced.  A complete version is never written over.
    """
    schema, spark = df.schema, df.sparkSession
    if is_complete(spark, manifest_path(root, version)):
        raise ValueError(f"version {version} of {root} is complete: it is not written over")
    remove_folder(spark, manifest_path(root, version))  # of a load by partitions that did not end
    mode = "overwrite" if not is_complete(spark, snapshot_path(root, version)) else "errorifexists"
    df, partition_by = _by_day(df, partition_by)
    if cluster_by:
        # Finding and sampling the ranges reads the state several times.
        df = clustered(stored(df, "unclustered"), cluster_by, within=partition_by)
    elif partition_by:
        df = by_partition(df, partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(snapshot_path(root, version))
    return read_snapshot(df.sparkSession, root, version, schema).select(*schema.names)


def _by_day(df: DataFrame, partition_by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Partition columns that hold a time become its day (``<name>_day``): a folder
    per moment would hold a row or two."""
    names = []
    for name in partition_by:
        if isinstance(df.schema[name].dataType, (TimestampType, TimestampNTZType)):
            df = df.withColumn(f"{name}_day", F.to_date(name))
            name = f"{name}_day"
        names.append(name)
    return df, names


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a table that is only ever added to."""
    writer = (by_partition(df, partition_by) if partition_by else df).write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_replacing(
    new: DataFrame, root: str, version: int, predicate: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """New version in which the rows matching ``predicate`` are replaced by ``new``."""
    old = read_snapshot(new.sparkSession, root, version - 1) if version > 1 else None
    return write_snapshot(
        replace_where(old, new, predicate).select(*new.columns), root, version, partition_by
    )


def write_quarantine(
    rejected: DataFrame,
    root: str,
    layer: str,
    table: str,
    run_id: str,
    as_of: Column | dt.datetime | str,
) -> str:
    """Write rejected rows as JSON lines to the run's folder.  Returns the folder.

    A re-run of the same run replaces its rows.
    """
    path = f"{root.rstrip('/')}/{layer}/{table}/{run_id}"
    with_audit(rejected, run_id, {"_rejection_timestamp": as_of}).write.mode("overwrite").json(path)
    return path


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def register_table(
    spark: SparkSession, name: str, schema: StructType, path: str, partition_by: Sequence[str] = ()
) -> None:
    """An external table over a folder, created once."""
    _create_table(spark, name, schema, path, partition_by)
    if partition_by:
        spark.catalog.recoverPartitions(name)


def _create_table(
    spark: SparkSession, name: str, schema: StructType, path: str, partition_by: Sequence[str]
) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitioned = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{partitioned} LOCATION '{path}'")


def register_version(
    spark: SparkSession, name: str, schema: StructType, root: str, version: int, partition_by: Sequence[str] = ()
) -> None:
    """An external table over one version, wherever its partitions lie.  May be repeated."""
    path = snapshot_path(root, version)
    if not has_manifest(spark, root, version):
        register_table(spark, name, schema, path, partition_by)
        return
    _create_table(spark, name, schema, path, partition_by)
    places = sorted(partition_places(spark, root, version).items())
    for at in range(0, len(places), _TOGETHER):
        entries = " ".join(
            f"PARTITION ({_spec(part)}) LOCATION '{folder_of(root, part, own)}'" for part, own in places[at : at + _TOGETHER]
        )
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {entries}")


def _spec(part: str) -> str:
    """A partition folder's name as a partition of SQL."""
    pairs = (piece.split("=", 1) for piece in part.split("/"))
    return ", ".join(
        f"`{unquote(k)}` = " + ("NULL" if v == NO_VALUE else "'" + unquote(v).replace("'", "\\'") + "'") for k, v in pairs
    )


def publish(spark: SparkSession, name: str, root: str, version: int) -> None:
    """Point the readers of ``name`` at one version (a catalog view, replaced in one step).

    A version with a manifest first gets a table of its own, ``name`` and the version; readers
    move when the view over it is replaced, so they see all partitions of one version or of the other.
    May be repeated at any time.
    """
    if not has_manifest(spark, root, version):
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{snapshot_path(root, version)}`")
        return
    schema = manifest_schema(spark, root, version)
    parts = next(iter(partition_places(spark, root, version)), "")
    columns = [unquote(piece.split("=", 1)[0]) for piece in parts.split("/") if piece]
    table = f"{name}_v{version}"
    register_version(spark, table, schema, root, version, columns)
    wanted = ", ".join(f"`{n}`" for n in schema.names)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {wanted} FROM {table}")


def upsert_into_partitions(
    table: str, source: DataFrame, keys: Sequence[str], partition: str, root: str, version: int
) -> list[int]:
    """Upsert into a registered table, rewriting only the partitions it touches.

    The next version of the stored table is written by
    :func:`sedimenta.sinks.partitions.upsert_version`; then the table's entries are
    pointed at what it changed: existing ones in place, so readers never miss a partition,
    new ones in one statement, emptied ones dropped.  A run that failed on the way is
    repeated: a complete version is not written again, and pointing takes up where it ended.
    The partition column holds whole numbers, as date and month keys are.
    Returns the touched partition values.
    """
    spark = source.sparkSession
    upsert_version(_with_partition(source, partition), keys, partition, root, version, schema=spark.table(table).schema)
    return _point_at(spark, table, root, version)


def _with_partition(rows: DataFrame, partition: str) -> DataFrame:
    message = F.lit(f"rows without a {partition} have no partition to be written to")
    value = F.coalesce(partition, F.raise_error(message).cast(rows.schema[partition].dataType))
    return rows.withColumn(partition, value)


def _partition_values(spark: SparkSession, table: str) -> set[int]:
    return {int(row[0].split("=")[1]) for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def _point_at(spark: SparkSession, table: str, root: str, version: int) -> list[int]:
    """Let the table's entries read what the version changed; those it dropped go."""
    places = partition_places(spark, root, version)
    known = _partition_values(spark, table)
    changed = changed_partitions(spark, root, version - 1, version)
    for part in sorted(p for p in changed & places.keys() if partition_value(p) in known):
        spark.sql(f"ALTER TABLE {table} PARTITION ({_spec(part)}) SET LOCATION '{folder_of(root, part, places[part])}'")
    added = sorted(p for p in changed & places.keys() if partition_value(p) not in known)
    if added:
        entries = " ".join(f"PARTITION ({_spec(p)}) LOCATION '{folder_of(root, p, places[p])}'" for p in added)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {entries}")
    gone = ", ".join(f"PARTITION ({_spec(p)})" for p in sorted(changed - places.keys()) if partition_value(p) in known)
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {gone}")
    spark.catalog.refreshTable(table)
    return sorted(partition_value(p) for p in changed)


def replace_partitions(
    table: str, new: DataFrame, partition: str, first: int, root: str, version: int
) -> None:
    """Swap all partitions of a registered table from ``first`` on for ``new``; earlier ones keep their files.

    A new row of an earlier partition stops the job.  Only ``new`` is written.  May be repeated.
    """
    spark = new.sparkSession
    replace_version(new.select(*spark.table(table).columns), partition, first, root, version)
    _point_at(spark, table, root, version)


def write_bucketed(
    df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int
) -> DataFrame:
    """Store a table hash-bucketed by key: merges by that key then do not shuffle it.

    ``df`` should come key-partitioned into ``buckets`` parts where it is not
    already (see :func:`sedimenta.operators.merge.merge_rows`), so that a task
    writes one bucket.
    """
    (
        df.write.bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .mode("errorifexists")
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)
