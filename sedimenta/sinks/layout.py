"""How rows are placed into files."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from sedimenta.operators.keys import with_surrogate_key
from sedimenta.session import stored


def by_partition(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition folder together before a partitioned write.

    A rebalance, not a repartition: adaptive execution splits the share of a hot
    value into several files of the advised size and merges small ones.
    """
    return df.hint("rebalance", *columns)


def _number(df: DataFrame, name: str) -> Column:
    """A number that orders like the column."""
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(kind, TimestampNTZType):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if isinstance(kind, BooleanType):
        return column.cast("int").cast("double")
    if isinstance(kind, NumericType):
        return column.cast("double")
    raise TypeError(f"cannot cluster by {name}: {kind.simpleString()}")


def _text_bounds(df: DataFrame, name: str, count: int) -> list[str]:
    """Whole values that cut the column's distinct values into ``count`` equal parts.

    Strings have no quantile function, so the distinct values are numbered in
    order on all executors and those at the cuts are kept.
    """
    values = with_surrogate_key(df.select(name).dropna().distinct(), [name], "_at")
    values = stored(values, "values")
    total = values.count()
    cuts = sorted({max(1, total * i // count) for i in range(1, count)}) if total else []
    at = {row["_at"]: row[name] for row in values.filter(F.col("_at").isin(cuts)).collect()} if cuts else {}
    return [at[max(1, total * i // count)] for i in range(1, count)] if total else []


def _bucket(value: Column, label: str, bounds: Sequence, bits: int) -> list[tuple[str, Column]]:
    """Binary search of a quantile bucket, one step (one column) per bit.

    Step columns hold how many bounds are known to lie at or below the value.
    """
    table = F.lit(list(bounds))
    steps: list[tuple[str, Column]] = []
    found: Column = F.lit(0)
    for level in reversed(range(bits)):
        half = 1 << level
        reached = F.element_at(table, (found + F.lit(half)).cast("int")) <= value
        name = f"{label}_{level}"
        steps.append((name, found + F.when(reached, F.lit(half)).otherwise(F.lit(0))))
        found = F.col(name)
    return steps


def _bits(df: DataFrame, columns: int, partitions: int | None) -> int:
    """Bits per column: enough cells for every output partition, 64 buckets at least."""
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(62 // columns, max(6, ceil(log2(max(2, parts)) / columns) + 2))


def cell_bounds(df: DataFrame, columns: Sequence[str], bits: int) -> dict[str, list]:
    """Per column, the values that cut its rows into ``1 << bits`` equal parts: a number of values that
    follows the bits, not the rows."""
    parts = 1 << bits
    texts = [c for c in columns if isinstance(df.schema[c].dataType, StringType)]
    numbers = {c: _number(df, c) for c in columns if c not in texts}
    bounds: dict[str, list] = {c: list(_text_bounds(df, c, parts)) for c in texts}
    if numbers:
        wanted = [i / parts for i in range(1, parts)]
        accuracy = max(10_000, 20 * parts)
        found = df.agg(*[F.percentile_approx(m, wanted, accuracy).alias(c) for c, m in numbers.items()]).first()
        bounds.update({c: list(found[c] or []) for c in numbers})
    return bounds


def with_cell(df: DataFrame, columns: Sequence[str], bounds: dict[str, list], bits: int) -> DataFrame:
    """Add ``_cell``: the interleaved bits of each column's bucket between its bounds."""
    texts = [c for c in columns if isinstance(df.schema[c].dataType, StringType)]
    placed = df
    code: Column = F.lit(0).cast("long")
    for index, name in enumerate(columns):
        label = f"_m{index}"
        if not bounds[name]:  # no value at all
            continue
        value = F.col(name) if name in texts else _number(df, name)
        for step, found in _bucket(value, label, bounds[name], bits):
            placed = placed.withColumn(step, found)
        bucket = F.coalesce(F.col(f"{label}_0"), F.lit(0)).cast("long")
        for bit in range(bits):
            part = F.shiftright(bucket, bit).bitwiseAND(F.lit(1))
            code = code.bitwiseOR(F.shiftleft(part, bit * len(columns) + index))
    return placed.withColumn("_cell", code).select(*df.columns, "_cell")


def clustered(
    df: DataFrame,
    columns: Sequence[str],
    within: Sequence[str] = (),
    partitions: int | None = None,
    bits: int | None = None,
) -> DataFrame:
    """Rows that are close in ``columns`` end up in the same files.

    One column: ranges of it.  Several: ranges of the interleaved bits of each
    column's quantile bucket, so a filter on any of them skips most files.
    A hash of the whole row comes last in the range order, so a value that many
    rows share is spread over several partitions instead of filling one.
    ``within`` names the partition folders of the write, which come first.
    ``df`` is read several times: give a stored table.
    """
    columns, within = list(columns), list(within)
    spread = F.xxhash64(*df.columns)
    count = [partitions] if partitions else []
    if len(columns) == 1:
        ranged = df.repartitionByRange(*count, *[F.col(c) for c in [*within, *columns]], spread)
        return ranged.sortWithinPartitions(*within, *columns)

    bits = bits or _bits(df, len(columns), partitions)
    ordered = with_cell(df, columns, cell_bounds(df, columns, bits), bits)
    order = [*within, "_cell", *columns]
    ranged = ordered.repartitionByRange(*count, *[F.col(c) for c in order], spread)
    return ranged.sortWithinPartitions(*order).drop("_cell")
