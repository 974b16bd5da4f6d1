"""Clustered tables that grow: only files whose ranges overlap are clustered again.

Every row has a cell, its place in the order of the clustering columns (see
:func:`sedimenta.sinks.layout.with_cell`), by cuts that are taken once.  A version is a small table,
written last, that names its files with the cells they span.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sedimenta.sinks.layout import cell_bounds, with_cell
from sedimenta.sources.versions import is_complete, snapshot_path

_BITS = 62


@dataclass(frozen=True)
class DataFile:
    """A file's path below the table's root, its rows, and the least and greatest cell in it."""

    path: str
    rows: int
    low: int
    high: int


def _list_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/_files/version={version:010d}"


def data_files(spark: SparkSession, root: str, version: int) -> list[DataFile]:
    """The files of a version: one row each, as a scan of it lists."""
    rows = spark.read.parquet(_list_path(root, version)).filter("settings IS NULL").orderBy("low", "high", "path").collect()
    return [DataFile(r["path"], r["rows"], r["low"], r["high"]) for r in rows]


def _settings(spark: SparkSession, root: str, version: int) -> dict:
    return json.loads(spark.read.parquet(_list_path(root, version)).filter("settings IS NOT NULL").first()["settings"])


def read_clusters(spark: SparkSession, root: str, version: int) -> DataFrame:
    """The table as of a version."""
    schema = StructType.fromJson(_settings(spark, root, version)["schema"])
    return _read(spark, root, schema, data_files(spark, root, version))


def _read(spark: SparkSession, root: str, schema: StructType, files: Sequence[DataFile]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root.rstrip('/')}/{f.path}" for f in files])


def _write(celled: DataFrame, root: str, version: int, columns: Sequence[str], count: int | None) -> list[DataFile]:
    """Rows in order of their cells, in about ``count`` files, with what each of these spans."""
    spark = celled.sparkSession
    names = [n for n in celled.columns if n != "_cell"]
    number = [count] if count else []
    order = ["_cell", *columns]
    # The hash spreads a cell that many rows share over several files.
    ranged = celled.repartitionByRange(*number, *order, F.xxhash64(*names)).sortWithinPartitions(*order)
    folder = snapshot_path(root, version)
    ranged.write.mode("overwrite").parquet(folder)
    spans = spark.read.parquet(folder).select("_cell", F.col("_metadata.file_name").alias("name"))
    found = spans.groupBy("name").agg(F.count(F.lit(1)).alias("rows"), F.min("_cell").alias("low"), F.max("_cell").alias("high"))
    place = folder.rpartition("/")[2]
    return [DataFile(f"{place}/{r['name']}", r["rows"], r["low"], r["high"]) for r in found.collect()]


def _list(spark: SparkSession, root: str, version: int, files: Sequence[DataFile], settings: dict) -> None:
    rows = [(f.path, f.rows, f.low, f.high, None) for f in files]
    kinds = "path string, rows long, low long, high long, settings string"
    listed = spark.createDataFrame([(None, None, None, None, json.dumps(settings)), *rows], kinds).coalesce(1)
    listed.write.mode("overwrite").parquet(_list_path(root, version))


def start_clusters(
    df: DataFrame, columns: Sequence[str], root: str, version: int = 1, files: int | None = None, bits: int | None = None
) -> DataFrame:
    """First version of a table clustered by ``columns``, in about ``files`` files.

    Cuts are taken of the rows as they are now and kept, so that cells of later rows compare with
    these; rows beyond all cuts share the outermost cells.  ``df`` is read several times: give a stored table.
    """
    spark, columns = df.sparkSession, list(columns)
    if not is_complete(spark, _list_path(root, version)):
        bits = bits or min(10, _BITS // len(columns))
        bounds = cell_bounds(df, columns, bits)
        settings = {"schema": df.schema.jsonValue(), "columns": columns, "bits": bits, "bounds": bounds}
        written = _write(with_cell(df, columns, bounds, bits), root, version, columns, files)
        _list(spark, root, version, written, settings)
    return read_clusters(spark, root, version)


def append_clusters(
    df: DataFrame, root: str, version: int, base: int | None = None, files: int | None = None
) -> DataFrame:
    """Next version with more rows, in files of their own."""
    spark = df.sparkSession
    base = version - 1 if base is None else base
    if not is_complete(spark, _list_path(root, version)):
        settings = _settings(spark, root, base)
        names = StructType.fromJson(settings["schema"]).names
        celled = with_cell(df.select(*names), settings["columns"], settings["bounds"], settings["bits"])
        written = _write(celled, root, version, settings["columns"], files)
        _list(spark, root, version, [*data_files(spark, root, base), *written], settings)
    return read_clusters(spark, root, version)


def overlapping(files: Sequence[DataFile], depth: int = 2) -> list[DataFile]:
    """Files that lie with ``depth - 1`` others over some stretch of cells.

    Touching in one cell does not count: a cell may fill several files.  One pass over the
    files' ends in order: where at least ``depth`` are open, all that are open are picked.
    """
    ends = sorted([(f.low, 1, i) for i, f in enumerate(files) if f.high > f.low] + [(f.high, 0, i) for i, f in enumerate(files) if f.high > f.low])
    open_, picked = set(), set()
    for _, opens, i in ends:  # at one cell, files that end come first
        if not opens:
            open_.discard(i)
            continue
        open_.add(i)
        if len(open_) >= depth:
            # Each file is added once: those picked before are left out of the set operation.
            picked |= open_ - picked
    return [f for i, f in enumerate(files) if i in picked]


def cluster_again(
    spark: SparkSession, root: str, version: int, base: int | None = None, depth: int = 2
) -> DataFrame:
    """Next version in which overlapping files (see :func:`overlapping`) are clustered together; all
    other files stay.  The new files are about as large as the table's are."""
    base = version - 1 if base is None else base
    if not is_complete(spark, _list_path(root, version)):
        settings, files = _settings(spark, root, base), data_files(spark, root, base)
        picked = overlapping(files, depth)
        kept = [f for f in files if f not in set(picked)]
        written: list[DataFile] = []
        if picked:
            schema = StructType.fromJson(settings["schema"])
            rows = sum(f.rows for f in picked)
            usual = max(sum(f.rows for f in files) // len(files), 1)
            celled = with_cell(_read(spark, root, schema, picked), settings["columns"], settings["bounds"], settings["bits"])
            written = _write(celled, root, version, settings["columns"], max(1, round(rows / usual)))
        _list(spark, root, version, [*kept, *written], settings)
    return read_clusters(spark, root, version)

