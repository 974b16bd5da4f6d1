"""Surrogate keys, unknown members and key lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.session import stored

# Fixed value: the key facts point at when a dimension row is missing.
UNKNOWN_KEY = -1

# monotonically_increasing_id() holds the partition number above this bit and
# the position inside the partition below it.
_POSITION_BITS = 33


def with_surrogate_key(
    df: DataFrame,
    order_by: Sequence[str],
    name: str,
    after: int | Column = 0,
    partitions: int | None = None,
) -> DataFrame:
    """Number the rows ``after + 1, after + 2, ...`` in ``order_by`` order, without gaps.

    Gives what ``row_number()`` over the whole table gives, but on all
    executors: rows are range-partitioned and sorted, each takes its position in
    its partition, and the partition's start is added from a table with one row
    per partition.  ``order_by`` should be a total order.  A hash of the row ends
    the range order, so a value that many rows share fills several partitions.

    Range bounds come from sampling, so the placed rows are written once to the
    shared folder; a lost executor re-reads them.
    """
    order_by = list(order_by)
    spread = F.xxhash64(*df.columns)
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *order_by, spread)
    placed = stored(
        ranged.sortWithinPartitions(*order_by, spread).withColumn("_slot", F.monotonically_increasing_id()),
        f"keys-{name}",
    )
    part = F.shiftright(F.col("_slot"), _POSITION_BITS)
    position = F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    # ``starts`` has one row per shuffle partition: its size is bounded by design.
    numbered = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    offset = after if isinstance(after, Column) else F.lit(after).cast("long")
    return numbered.select(*df.columns, (F.col("_start") + position + F.lit(1) + offset).cast("long").alias(name))


def greatest_key(df: DataFrame, name: str) -> Column:
    """The greatest key in use as a scalar subquery; 0 for an empty table."""
    return df.agg(F.coalesce(F.max(name), F.lit(0)).cast("long")).scalar()


def with_unknown_member(df: DataFrame, key: str, values: Mapping[str, Any]) -> DataFrame:
    """Add the unknown row, by column name, unless the table has one already."""
    row = {**values, key: UNKNOWN_KEY}
    unknown_names = set(row) - set(df.columns)
    if unknown_names:
        raise ValueError(f"not columns of the table: {sorted(unknown_names)}")
    spark = df.sparkSession
    literal = spark.range(1).select(
        *[F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
    present = df.filter(F.col(key) == UNKNOWN_KEY).select(key)
    return df.unionByName(literal.join(present, key, "left_anti").select(*df.columns))


def lookup_key(
    facts: DataFrame, dimension: DataFrame, fact_column: str, dimension_column: str, key: str
) -> DataFrame:
    """Add ``key`` from the dimension row that matches, or the unknown key.

    A left join on a pruned dimension (two columns).  Spark broadcasts it when
    its measured size allows; otherwise adaptive execution splits the partitions
    of hot or NULL fact keys, which a left join permits.
    """
    pairs = dimension.select(F.col(dimension_column).alias("_lookup"), F.col(key).alias("_found"))
    joined = facts.join(pairs, facts[fact_column] == F.col("_lookup"), "left")
    found = F.coalesce(F.col("_found"), F.lit(UNKNOWN_KEY)).cast("long")
    return joined.withColumn(key, found).drop("_lookup", "_found")
