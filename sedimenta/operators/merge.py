"""Next-state merges over plain files: the result is the whole new table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.functions.columns import all_present, any_missing


def unique_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` as it is; a key that occurs twice stops the job that reads it.

    The rows of a key are counted where the merge needs them together anyway, so
    no job and no shuffle is added to a join by the same keys.  Rows with a NULL key
    match nothing, may be many, and stay out of it.
    """
    keys = list(keys)
    shown = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys])
    message = F.concat(F.lit("several source rows share one key ("), shown, F.lit("); keep one row per key first"))
    counted = df.filter(all_present(keys)).withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    once = F.when(F.col("_rows") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return counted.filter(once).drop("_rows").unionByName(df.filter(any_missing(keys)))


def merge_rows(
    target: DataFrame, written: DataFrame, keys: Sequence[str], touched: DataFrame | None = None
) -> DataFrame:
    """``target`` without the touched keys, plus the written rows.

    ``touched`` defaults to the keys of ``written``; give it when keys are also
    removed.  ``written`` must hold each key once.  Columns only the target has
    keep the target's value on matched rows; columns only the source has appear
    as NULL on the rest.

    Rows of the target with a NULL key match nothing and bypass the join.  The
    rest hold a key once, so no partition of the join can be hot.  The target is
    read for both parts: give a stored table, where the second read skips every
    row group without NULL keys.
    """
    keys = list(keys)
    kept_columns = [c for c in target.columns if c not in written.columns]
    if kept_columns:
        written = written.join(target.select(*keys, *kept_columns).dropna(subset=keys), keys, "left")
    if touched is None:
        touched = written.select(*keys)
    kept = target.filter(all_present(keys)).join(touched, keys, "left_anti").select(*target.columns)
    passed = target.filter(any_missing(keys))
    return kept.unionByName(passed).unionByName(written, allowMissingColumns=True)


def upsert(target: DataFrame | None, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace matched rows, add the rest, delete nothing.  No target: the source is the table.

    A source key that occurs twice stops the job.
    """
    written = unique_rows(source, keys)
    if target is None:
        return written
    # The rows written are counted; the keys to leave out need no counting.
    return merge_rows(target, written, keys, touched=source.select(*keys))


def touched_partitions(
    target: DataFrame, source: DataFrame, keys: Sequence[str], partition: str
) -> DataFrame:
    """Partition values an upsert changes: those it writes to and those its rows leave.

    Of the target only the key and partition columns are read.
    """
    keys = list(keys)
    left = target.select(*keys, partition).join(source.select(*keys), keys, "left_semi").select(partition)
    return source.select(partition).unionByName(left).distinct()


def upsert_touched(
    target: DataFrame, source: DataFrame, keys: Sequence[str], partition: str, touched: Sequence
) -> DataFrame:
    """Next state of the touched partitions only (an emptied one has no rows).

    ``touched`` holds the collected values of :func:`touched_partitions`, at most
    one per partition folder.  As constants they prune the target's folders
    before the job starts.  The partition column must not be NULL.
    """
    if any(value is None for value in touched):
        raise ValueError(f"rows without a {partition} have no partition to be written to")
    return upsert(target.filter(F.col(partition).isin(*touched)), source, keys)


def upsert_keeping(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    keep: Sequence[str],
    defaults: dict[str, Column],
) -> DataFrame:
    """Upsert that keeps the target's value of some columns on matched rows.

    ``keep`` columns (for example a surrogate key) come from the target where
    the key exists; otherwise from the source, or from ``defaults`` if the
    source lacks them.  One full outer join, so each side is shuffled once.
    Rows with a NULL key match nothing and stay out of the join.  A source key
    that occurs twice stops the job.
    """
    source = source.withColumns({n: v for n, v in defaults.items() if n not in source.columns})
    source = unique_rows(source, keys)
    if target is None:
        return source
    keys, columns = list(keys), target.columns
    extra = [c for c in source.columns if c not in columns]
    old, new = target.filter(all_present(keys)).alias("t"), source.filter(all_present(keys)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    # Keys are never NULL here, so a NULL key tells that a side is absent.
    in_target, in_source = F.col(f"t.{keys[0]}").isNotNull(), F.col(f"s.{keys[0]}").isNotNull()

    def pick(name: str) -> Column:
        if name not in columns:
            return F.col(f"s.{name}")
        if name not in source.columns:
            return F.col(f"t.{name}")
        if name in keep:
            return F.when(in_target, F.col(f"t.{name}")).otherwise(F.col(f"s.{name}")).alias(name)
        return F.when(in_source, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}")).alias(name)

    merged = old.join(new, on, "full").select(*[pick(c) for c in [*columns, *extra]])
    return merged.unionByName(target.filter(any_missing(keys)), allowMissingColumns=True).unionByName(
        source.filter(any_missing(keys)), allowMissingColumns=True
    )


def union_evolving(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Union by name; a column missing on one side is NULL there."""
    return older.unionByName(newer, allowMissingColumns=True)


def replace_where(old: DataFrame | None, new: DataFrame, predicate: str) -> DataFrame:
    """Swap the rows that match ``predicate`` for ``new`` (no ``old``: a first load).

    A new row outside the predicate fails the job: it would land in a part of
    the table that is not being replaced.  Rows where the predicate is NULL
    stay.
    """
    inside = F.coalesce(F.expr(predicate), F.lit(False))
    message = F.lit(f"a new row does not satisfy: {predicate}")
    checked = new.filter(F.when(inside, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return checked if old is None else old.filter(~inside).unionByName(checked)
