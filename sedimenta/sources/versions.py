"""Which folder holds each partition of a version.

A version is either one whole folder, or a manifest: a small table, written last,
that names for every partition the version whose folder holds it.  A load that changes
a few partitions writes these and a manifest; all else stays where it is, and every
older version keeps reading whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Folder name of a partition without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def snapshot_path(root: str, version: int) -> str:
    """Folder of one version of a table; the number is padded so that names sort."""
    return f"{root.rstrip('/')}/version={version:010d}"


def manifest_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/_manifests/version={version:010d}"


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to the folder has come to its end."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def make_folder(spark: SparkSession, path: str) -> None:
    system, place = _place(spark, path)
    system.mkdirs(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    system, place = _place(spark, path)
    system.delete(place, True)


def child_folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in a folder; none where there is no such folder."""
    system, place = _place(spark, folder)
    if not system.exists(place):
        return []
    found = [status.getPath().getName() for status in system.listStatus(place) if status.isDirectory()]
    return sorted(name for name in found if not name.startswith(("_", ".")))


def partition_folders(spark: SparkSession, folder: str) -> list[str]:
    """Partitions below a folder, as ``a=1/b=2``: a listing, no file is read."""
    system, place = _place(spark, folder)
    found = []
    for status in system.listStatus(place):
        name = status.getPath().getName()
        if status.isDirectory() and "=" in name and not name.startswith("."):
            inner = partition_folders(spark, f"{folder.rstrip('/')}/{name}")
            found += [f"{name}/{deeper}" for deeper in inner] or [name]
    return sorted(found)


def has_manifest(spark: SparkSession, root: str, version: int) -> bool:
    """Whether the version is read by a manifest.  One that a load began and did not end is no version."""
    path = manifest_path(root, version)
    if is_complete(spark, path):
        return True
    if exists(spark, path):
        raise ValueError(f"version {version} of {root} is not complete: run its load again")
    return False


def partition_places(spark: SparkSession, root: str, version: int) -> dict[str, int]:
    """For every partition of a version, the version whose folder holds it.

    A table without partitions is one, named by the empty string.  One entry per
    partition folder, as a catalog holds.
    """
    if has_manifest(spark, root, version):
        rows = spark.read.parquet(manifest_path(root, version)).filter("schema IS NULL").collect()
        return {row["part"]: row["version"] for row in rows}
    folder = snapshot_path(root, version)
    return dict.fromkeys(partition_folders(spark, folder) or _whole(spark, folder), version)


def _whole(spark: SparkSession, folder: str) -> list[str]:
    """The one part of a folder of files; a partitioned table without rows has none."""
    system, place = _place(spark, folder)
    names = [status.getPath().getName() for status in system.listStatus(place)]
    return [""] if any(not name.startswith(("_", ".")) for name in names) else []


def manifest_schema(spark: SparkSession, root: str, version: int) -> StructType:
    row = spark.read.parquet(manifest_path(root, version)).filter("schema IS NOT NULL").first()
    return StructType.fromJson(json.loads(row["schema"]))


def folder_of(root: str, part: str, version: int) -> str:
    return f"{snapshot_path(root, version)}/{part}".rstrip("/")


def read_places(spark: SparkSession, root: str, places: Mapping[str, int], schema: StructType) -> DataFrame:
    """The rows of some partitions, wherever they lie, in one scan; partition values come from the folder names."""
    if not places:
        return spark.createDataFrame([], schema)
    paths = [folder_of(root, part, version) for part, version in sorted(places.items())]
    if "version" not in [name.lower() for name in schema.names]:
        return spark.read.schema(schema).option("basePath", root).parquet(*paths).select(*_quoted(schema))
    # The table's own ``version`` must not be taken for the folder's: a scan per folder.
    frames = []
    for at in sorted(set(places.values())):
        own = [folder_of(root, part, version) for part, version in sorted(places.items()) if version == at]
        reader = spark.read.schema(schema).option("basePath", snapshot_path(root, at))
        frames.append(reader.parquet(*own).select(*_quoted(schema)))
    rows = frames[0]
    for more in frames[1:]:
        rows = rows.unionByName(more)
    return rows


def _quoted(schema: StructType) -> list[str]:
    return [f"`{name.replace('`', '``')}`" for name in schema.names]


def read_version(spark: SparkSession, root: str, version: int, schema: StructType | None = None) -> DataFrame:
    """A version that has a manifest."""
    places = partition_places(spark, root, version)
    return read_places(spark, root, places, schema or manifest_schema(spark, root, version))


def partition_names(spark: SparkSession, values: DataFrame, columns: Sequence[str]) -> set[str]:
    """Folder names of the partitions that ``values`` (one row each) stand for."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    rows = values.select(*[F.col(c).cast("string") for c in columns]).distinct().collect()
    return {"/".join(f"{escape(c)}={escape(v) if v else NO_VALUE}" for c, v in zip(columns, row, strict=True)) for row in rows}


def changed_partitions(spark: SparkSession, root: str, older: int, newer: int) -> set[str]:
    """Partitions that the newer version added, wrote again or dropped."""
    before, after = partition_places(spark, root, older), partition_places(spark, root, newer)
    return {part for part in before.keys() | after.keys() if before.get(part) != after.get(part)}


def without(places: Mapping[str, int], parts: Iterable[str]) -> dict[str, int]:
    gone = set(parts)
    return {part: version for part, version in places.items() if part not in gone}
