"""History tables: one row per version of a key.

``_is_current`` marks the open version, ``_valid_from``/``_valid_to`` bound it.
The source must hold each key once; one that occurs twice stops the job.  Keys the source does not mention stay as
they are.  Everything is derived from one unchanging target, so the order in
which parts run cannot matter.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.columns import all_present, any_differs, any_missing, moment, row_hash
from sedimenta.operators.merge import unique_rows

HISTORY_COLUMNS = ("_hash_key", "_is_current", "_valid_from", "_valid_to")


def _opened(df: DataFrame, tracked: Sequence[str], since: Column) -> DataFrame:
    return df.withColumns(
        {
            "_hash_key": row_hash(df, tracked),
            "_is_current": F.lit(True),
            "_valid_from": since,
            "_valid_to": F.lit(None).cast("timestamp"),
        }
    )


def _stamp(target: DataFrame, as_of: Column | dt.datetime | str) -> Column:
    return moment(as_of, target.schema["_valid_from"].dataType)


def current_rows(target: DataFrame) -> DataFrame:
    return target.filter(F.col("_is_current"))


def scd2_initial(source: DataFrame, tracked: Sequence[str], as_of: Column | dt.datetime | str) -> DataFrame:
    """First load: every row is a current version."""
    since = moment(as_of)
    opened = _opened(source, tracked, since)
    return opened.withColumn("_valid_to", F.lit(None).cast(opened.schema["_valid_from"].dataType))


def scd2_changed_keys(
    target: DataFrame, source: DataFrame, keys: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """Keys whose current version differs from the source in a tracked column."""
    keys = list(keys)
    live = current_rows(target).select(*keys, *tracked).alias("t")
    wanted = source.select(*keys, *tracked).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    return (
        live.join(wanted, on, "inner")
        .filter(any_differs("t", "s", tracked))
        .select(*[F.col(f"t.{k}") for k in keys])
        .distinct()
    )


def scd2_new_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: Column | dt.datetime | str,
) -> DataFrame:
    """Source rows whose key has no current version, as first versions."""
    unseen = source.join(current_rows(target).select(*keys), list(keys), "left_anti").select(*source.columns)
    opened = _opened(unseen, tracked, _stamp(target, as_of))
    return opened.withColumn("_valid_to", F.lit(None).cast(target.schema["_valid_to"].dataType))


def scd2_expired_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: Column | dt.datetime | str,
) -> DataFrame:
    """Current versions that the source replaces, as they look once closed."""
    changed = scd2_changed_keys(target, source, keys, tracked)
    closing = current_rows(target).join(changed, list(keys), "left_semi")
    return closing.withColumns({"_is_current": F.lit(False), "_valid_to": _stamp(target, as_of)}).select(
        *target.columns
    )


def scd2_apply(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: Column | dt.datetime | str,
    small_source: bool = False,
) -> DataFrame:
    """Next state of a history table.

    Closed versions pass through without a shuffle.  Current versions meet the
    source in one full outer join, so each side is shuffled once, data columns
    only; each joined pair then becomes one or two output rows.  Both sides hold
    a key once, and rows with a NULL key match nothing and bypass the join, so
    no partition of it can be hot.

    ``small_source`` suits a stored batch whose files are below Spark's broadcast
    threshold: left and semi joins take the place of the full outer one, so the target is read a second time
    (keys only) but not shuffled.  The result is the same either way, and so is
    it when the batch turns out too large to broadcast.
    """
    keys = list(keys)
    source = unique_rows(source, keys)
    if target is None:
        return scd2_initial(source, tracked, as_of)
    stamps = {
        "_is_current": F.lit(True),
        "_valid_from": _stamp(target, as_of),
        "_valid_to": F.lit(None),
    }
    types = {f.name: f.dataType for f in [*source.schema.fields, *target.schema.fields]}
    columns = [*target.columns, *[c for c in source.columns if c not in target.columns]]

    def version(side: str | None, have: Sequence[str], given: dict[str, Column]) -> list[Column]:
        """All output columns, taken from one side of the join (or the frame itself)."""
        prefix = f"{side}." if side else ""
        return [
            (given[c] if c in given else F.col(f"{prefix}{c}") if c in have else F.lit(None))
            .cast(types[c])
            .alias(c)
            for c in columns
        ]

    live = target.filter(F.col("_is_current") & all_present(keys)).alias("t")
    arriving = source.filter(all_present(keys)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    kept = F.struct(*version("t", target.columns, {}))
    closed = F.struct(
        *version("t", target.columns, {"_is_current": F.lit(False), "_valid_to": stamps["_valid_from"]})
    )
    opened = F.struct(
        *version("s", source.columns, {**stamps, "_hash_key": row_hash(source, tracked, "s")})
    )
    # Keys are never NULL here, so a NULL key tells that a side is absent.
    met = (
        F.when(F.col(f"s.{keys[0]}").isNull(), F.array(kept))
        .when(any_differs("t", "s", tracked), F.array(closed, opened))
        .otherwise(F.array(kept))
    )
    if small_source:
        seen = target.filter(F.col("_is_current")).select(*keys).join(source.select(*keys), keys, "left_semi")
        fresh = arriving.join(seen, keys, "left_anti").alias("s").select(opened.alias("row")).select("row.*")
        joined = live.join(arriving, on, "left").select(F.inline(met)).unionByName(fresh)
    else:
        absent = F.col(f"t.{keys[0]}").isNull()
        joined = live.join(arriving, on, "full").select(
            F.inline(F.when(absent, F.array(opened)).otherwise(met))
        )

    current = F.col("_is_current")
    passed = target.filter(~current | current.isNull() | any_missing(keys))
    keyless = source.filter(any_missing(keys))
    added = keyless.select(*version(None, source.columns, {**stamps, "_hash_key": row_hash(source, tracked)}))
    return joined.unionByName(passed, allowMissingColumns=True).unionByName(added)


def scd2_moves(
    live: DataFrame, source: DataFrame, keys: Sequence[str], tracked: Sequence[str], as_of: Column | dt.datetime | str
) -> DataFrame:
    """What a load changes and nothing else: versions it closes, as they look then, and versions it opens.

    ``live`` holds current versions.  One left join from the source; rows with a NULL
    key match nothing, open a version each and stay out of it.
    """
    keys = list(keys)
    source = unique_rows(source, keys)
    since = _stamp(live, as_of)
    new_names = [c for c in source.columns if c not in live.columns]
    types = {f.name: f.dataType for f in [*source.schema.fields, *live.schema.fields]}
    ended = {"_is_current": F.lit(False), "_valid_to": since}
    begun = {"_hash_key": row_hash(source, tracked, "s"), "_is_current": F.lit(True), "_valid_from": since}

    def row(side: str, have: Sequence[str], given: dict[str, Column]) -> Column:
        values = [given.get(c, F.col(f"{side}.`{c}`") if c in have else F.lit(None)) for c in [*live.columns, *new_names]]
        return F.struct(*[v.cast(types[c]).alias(c) for v, c in zip(values, [*live.columns, *new_names], strict=True)])

    closed, opened = row("t", live.columns, ended), row("s", source.columns, begun)
    here, there = source.filter(all_present(keys)).alias("s"), current_rows(live).alias("t")
    met = here.join(there, [F.col(f"s.`{k}`") == F.col(f"t.`{k}`") for k in keys], "left")
    absent = F.col(f"t.`{keys[0]}`").isNull()
    moved = met.filter(absent | any_differs("t", "s", tracked)).select(
        F.inline(F.when(absent, F.array(opened)).otherwise(F.array(closed, opened)))
    )
    return moved.unionByName(source.filter(any_missing(keys)).alias("s").select(opened.alias("row")).select("row.*"))
