"""Tables in key-hash folders: a load reads and writes only the folders that its keys fall into.

The folder of a row is its ``_bucket``; how many there are is kept with the table's schema.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.changes import newer_changes, positions, positions_of
from sedimenta.operators.history import scd2_moves
from sedimenta.session import stored
from sedimenta.sinks.partitions import write_partitions
from sedimenta.sources.tables import read_snapshot
from sedimenta.sources.versions import (
    is_complete,
    manifest_path,
    manifest_schema,
    partition_names,
    partition_places,
    read_places,
)

BUCKET = "_bucket"


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int, otherwise: Column | None = None) -> DataFrame:
    """Add the folder of each row by its keys; where ``otherwise`` has a value, that one."""
    own = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    value = own if otherwise is None else F.coalesce(otherwise, own)
    return df.withColumn(BUCKET, value).withMetadata(BUCKET, {"buckets": buckets})


def start_buckets(df: DataFrame, keys: Sequence[str], root: str, buckets: int, version: int = 1) -> DataFrame:
    """First version of a table in ``buckets`` folders by ``keys``."""
    return write_partitions(with_bucket(df, keys, buckets), root, version, [BUCKET])


def bucket_count(spark: SparkSession, root: str, version: int) -> int:
    return manifest_schema(spark, root, version)[BUCKET].metadata["buckets"]


def _folders_of(rows: DataFrame, root: str, version: int) -> tuple[DataFrame, set[str]]:
    """The stored rows in the folders that ``rows`` fall into, and these folders' names."""
    spark = rows.sparkSession
    names = partition_names(spark, rows, [BUCKET])
    places = partition_places(spark, root, version)
    schema = manifest_schema(spark, root, version)
    return read_places(spark, root, {p: at for p, at in places.items() if p in names}, schema), names


def start_history(history: DataFrame, keys: Sequence[str], root: str, buckets: int, version: int = 1) -> DataFrame:
    """Store a history table (see :func:`sedimenta.operators.history.scd2_initial`) in two parts.

    Current versions lie in key-hash folders; closed ones in a folder per load that closed them
    (numbered ``-version``), which is never read or written by a later load.
    """
    closed = F.when(~F.coalesce(F.col("_is_current"), F.lit(False)), F.lit(-version))
    return write_partitions(with_bucket(history, keys, buckets, closed), root, version, [BUCKET])


def load_history(
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    root: str,
    version: int,
    as_of: Column | dt.datetime | str,
    base: int | None = None,
) -> DataFrame:
    """Next version of a history in two parts; the rows are those of
    :func:`sedimenta.operators.history.scd2_apply`.

    The source meets the current versions in the folders of its keys, once.  Only
    folders in which a version opens are written again; closed versions are added.  May
    be repeated like any load by partitions.
    """
    spark = source.sparkSession
    base = version - 1 if base is None else base
    if is_complete(spark, manifest_path(root, version)):
        return read_snapshot(spark, root, version)
    buckets = bucket_count(spark, root, base)
    source = stored(with_bucket(source, keys, buckets), "batch")
    live, _ = _folders_of(source, root, base)
    moves = scd2_moves(live.drop(BUCKET), source.drop(BUCKET), keys, tracked, as_of)
    closed = F.when(~F.col("_is_current"), F.lit(-version))
    moves = stored(with_bucket(moves, keys, buckets, closed), "moves")
    opened = moves.filter("_is_current")
    live, touched = _folders_of(opened, root, base)
    # A NULL key matches nothing, so such a version stays and others come beside it.
    kept = live.join(opened.select(*keys), list(keys), "left_anti").select(*live.columns)
    state = moves.unionByName(kept, allowMissingColumns=True)
    state = state.select(*[c for c in state.columns if c != BUCKET], BUCKET).withMetadata(BUCKET, {"buckets": buckets})
    return write_partitions(state, root, version, [BUCKET], touched, base)


def current_part(history: DataFrame) -> DataFrame:
    """Current versions of a stored history: folders of closed ones are not listed in the scan."""
    return history.filter((F.col(BUCKET) >= 0) & F.col("_is_current"))


def start_guarded(
    df: DataFrame,
    keys: Sequence[str],
    root: str,
    buckets: int,
    order_by: Sequence[str],
    at: Sequence | None = None,
    version: int = 1,
) -> DataFrame:
    """Store a full copy as a state that knows the position of every row (see
    :func:`apply_guarded`).

    ``at`` is the position the copy was made at (one value per ``order_by`` column):
    changes up to it are not applied.  Without it any change is newer.
    """
    values = [None] * len(order_by) if at is None else list(at)
    state = df.withColumns({f"_applied{c}": F.lit(v).cast("long") for c, v in zip(order_by, values, strict=True)})
    return start_buckets(state.withColumn("_deleted", F.lit(False)), keys, root, buckets, version)


def apply_guarded(
    changes: DataFrame,
    keys: Sequence[str],
    root: str,
    version: int,
    run_id: str,
    as_of: Column | dt.datetime | str,
    order_by: Sequence[str] = ("_cdc_version", "_cdc_seq"),
    code: str = "_cdc_operation_code",
    base: int | None = None,
) -> DataFrame:
    """Next version of a guarded state after a batch of change rows, whatever was applied before.

    Per key the latest change of the batch is applied if its position (``order_by``) is
    behind that of the last one applied to the key; a deleted key leaves a row that says
    so, with its position.  So windows may overlap, batches may be repeated or come
    late: rows neither go back nor come back.  Keys compare null-safely here, so that a
    repeated row without key is not added twice.

    The batch is reduced and stored once, then meets the rows of the folders its keys fall into;
    only folders in which something changes are written.
    """
    spark = changes.sparkSession
    base = version - 1 if base is None else base
    if is_complete(spark, manifest_path(root, version)):
        return read_snapshot(spark, root, version)
    buckets = bucket_count(spark, root, base)
    latest = newer_changes(changes, keys, order_by, code, run_id, as_of)
    latest = stored(with_bucket(latest, keys, buckets), "latest")
    old, _ = _folders_of(latest, root, base)
    won = latest.alias("s").join(
        old.select(*keys, *positions(order_by)).withColumn("_known", F.lit(True)).alias("t"), _same(keys), "left"
    )
    newer = F.col("t._known").isNull() | (positions_of("s", order_by) > positions_of("t", order_by))
    won = stored(won.filter(newer).select("s.*"), "won")
    old, touched = _folders_of(won, root, base)
    kept = old.alias("t").join(won.select(*keys).alias("s"), _same(keys), "left_anti").select(*[F.col(f"t.`{c}`") for c in old.columns])
    state = kept.unionByName(won, allowMissingColumns=True)
    state = state.select(*[c for c in state.columns if c != BUCKET], BUCKET).withMetadata(BUCKET, {"buckets": buckets})
    return write_partitions(state, root, version, [BUCKET], touched, base)


def _same(keys: Sequence[str]) -> Column:
    first, *rest = [F.col(f"s.`{k}`").eqNullSafe(F.col(f"t.`{k}`")) for k in keys]
    for more in rest:
        first = first & more
    return first


def live_rows(state: DataFrame, order_by: Sequence[str] = ("_cdc_version", "_cdc_seq")) -> DataFrame:
    """The rows of a guarded state that are not deleted, without what guards them."""
    return state.filter(~F.col("_deleted")).drop("_deleted", BUCKET, *positions(order_by))

