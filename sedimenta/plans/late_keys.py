"""Facts that came before their dimension row: which ones, and their keys once it arrives."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sedimenta.functions.columns import all_present
from sedimenta.operators.keys import UNKNOWN_KEY
from sedimenta.session import stored
from sedimenta.sinks.partitions import write_partitions
from sedimenta.sinks.tables import write_snapshot
from sedimenta.sources.tables import read_snapshot
from sedimenta.sources.versions import (
    is_complete,
    manifest_path,
    partition_names,
    partition_places,
    read_places,
    snapshot_path,
)


@dataclass(frozen=True)
class Reference:
    """A surrogate key of a fact (``key``) and the source column it is looked up by."""

    key: str
    source_column: str
    dimension_column: str


def open_references(
    facts: DataFrame, source: DataFrame | None, keys: Sequence[str], partition: str, references: Sequence[Reference]
) -> DataFrame:
    """One row per fact and reference that holds the unknown key: the fact's ``keys`` and partition,
    the ``reference`` (its key's name) and the ``wanted`` business key, as text.

    Only facts with an unknown key are joined with the source they were made of (by
    ``keys``).  Without a ``source`` the facts, a stored table, are the source and carry its columns
    themselves: only facts whose keys repeat are joined then.  Facts with a NULL key stay out in
    either case.  A reference that is NULL in the source names nothing to wait for.
    """
    if source is None:
        present = facts.filter(all_present(keys))
        counted = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        repeated = stored(counted.filter("_rows > 1").select(*keys), "repeated")
        again = present.join(repeated, list(keys), "left_semi").select(*facts.columns)
        several = open_references(again, again, keys, partition, references)
        once = _open_references(present, None, keys, partition, references)
        return once.join(repeated, list(keys), "left_anti").select(*several.columns).unionByName(several)
    return _open_references(facts, source, keys, partition, references)


def _open_references(
    facts: DataFrame, source: DataFrame | None, keys: Sequence[str], partition: str, references: Sequence[Reference]
) -> DataFrame:
    """Rows of :func:`open_references`; without a ``source`` each fact is met by itself only."""
    keys = list(keys)
    unknown = [F.col(f"f.{r.key}") == UNKNOWN_KEY for r in references]
    some = unknown[0]
    for more in unknown[1:]:
        some = some | more
    columns = dict.fromkeys(r.source_column for r in references)
    own = columns if source is None else ()
    kept = facts.select(*keys, partition, *[r.key for r in references], *own).alias("f").filter(some)
    if source is None:
        met, side = kept, "f"
    else:
        on = [F.col(f"f.{k}") == F.col(f"s.{k}") for k in keys]
        met, side = kept.join(source.select(*keys, *columns).alias("s"), on), "s"
    rows = [
        F.struct(
            F.lit(r.key).alias("reference"), F.when(u, F.col(f"{side}.{r.source_column}").cast("string")).alias("wanted")
        )
        for r, u in zip(references, unknown, strict=True)
    ]
    listed = met.select(*[F.col(f"f.{k}").alias(k) for k in keys], f"f.{partition}", F.inline(F.array(*rows)))
    return listed.filter(F.col("wanted").isNotNull())


def next_open_references(old: DataFrame | None, new: DataFrame, rebuilt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The standing table after a load: rows of facts that it ``rebuilt`` (their ``keys``) are those of
    ``new``, all others stay."""
    if old is None:
        return new
    kept = old.join(rebuilt.select(*keys).distinct(), list(keys), "left_anti")
    return kept.select(*new.columns).unionByName(new)


def resolved_references(
    waiting: DataFrame, references: Sequence[Reference], dimensions: Mapping[str, DataFrame]
) -> DataFrame:
    """Open references whose dimension row is there, with its key (``_found``); stored, as a build uses
    them several times.

    ``dimensions`` gives for each reference (by its key's name) the rows to look up: for
    a history its current ones.
    """
    found = None
    for r in references:
        rows = dimensions[r.key].select(F.col(r.dimension_column).cast("string").alias("wanted"), F.col(r.key).alias("_found"))
        rows = rows.filter(F.col("wanted").isNotNull() & (F.col("_found") != UNKNOWN_KEY)).withColumn("reference", F.lit(r.key))
        found = rows if found is None else found.unionByName(rows)
    return stored(waiting.join(found, ["reference", "wanted"]), "resolved")


def still_open(waiting: DataFrame, resolved: DataFrame, keys: Sequence[str]) -> DataFrame:
    on = [*keys, "reference"]
    return waiting.join(resolved.select(*on), on, "left_anti").select(*waiting.columns)


def rekeyed(
    facts: DataFrame, keys: Sequence[str], references: Sequence[Reference], resolved: DataFrame, only: bool = False
) -> DataFrame:
    """``facts`` with the keys of resolved references where they hold the unknown one; with ``only``, just the
    facts that have such a reference."""
    keys, kinds = list(keys), {f.name: f.dataType for f in facts.schema.fields}
    wide = resolved.groupBy(*keys).agg(
        *[F.max(F.when(F.col("reference") == r.key, F.col("_found"))).alias(f"_new_{r.key}") for r in references]
    )
    joined = facts.join(wide, keys, "inner" if only else "left")
    given = {r.key: F.coalesce(F.when(F.col(r.key) == UNKNOWN_KEY, F.col(f"_new_{r.key}")), F.col(r.key)) for r in references}
    return joined.select(*[given[c].cast(kinds[c]).alias(c) if c in given else F.col(f"`{c}`") for c in facts.columns])


def facts_of(
    spark: SparkSession, root: str, version: int, names: set[str], schema: StructType | None = None
) -> DataFrame:
    """The stored facts in some partitions."""
    places = partition_places(spark, root, version)
    schema = schema or read_snapshot(spark, root, version).schema
    return read_places(spark, root, {p: at for p, at in places.items() if p in names}, schema)


def rekey_facts(
    spark: SparkSession,
    facts_root: str,
    open_root: str,
    version: int,
    keys: Sequence[str],
    partition: str,
    references: Sequence[Reference],
    dimensions: Mapping[str, DataFrame],
    base: int | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Next version of the facts, in which references whose dimension row has arrived hold its key.

    Open references (see :func:`open_references`, a stored table in versions of the facts' numbers)
    are joined with the ``dimensions`` (see :func:`resolved_references`); only partitions that hold a
    resolved one are read and written, and the next version of the open references holds the rest.
    May be repeated: the facts are written first, and what is open follows from the
    version before.
    """
    base = version - 1 if base is None else base
    waiting = read_snapshot(spark, open_root, base)
    resolved = resolved_references(waiting, references, dimensions)
    if not is_complete(spark, manifest_path(facts_root, version)):
        names = partition_names(spark, resolved, [partition])
        facts = facts_of(spark, facts_root, base, names, schema)
        write_partitions(rekeyed(facts, keys, references, resolved), facts_root, version, [partition], names, base)
    if not is_complete(spark, snapshot_path(open_root, version)):
        write_snapshot(still_open(waiting, resolved, keys), open_root, version)
    return read_snapshot(spark, facts_root, version, schema)
