"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.carried import packed, quoted, unpacked
from sedimenta.session import stored

_EXACT = "decimal(38,12)"
_POSITION_BITS = 33
_READ, _ADDED = ("doc_id", "text", "source"), ("size", "source_size", "target", "copies")


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; NULL counts as an empty text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """One row per source key ``_k``: ``source_size`` and ``target``.

    Sources in code-point order, NULL last, take ``weights`` in turn.  They share
    ``share`` times all sizes by weight; a source stops at ``most`` times its own
    size and its excess goes to the others by weight.  With sources ordered by the
    level (target / weight) at which they stop, the level of the rest follows
    from running sums, so no round-by-round sharing is needed.
    """
    sources = sized.groupBy("_k").agg(F.first("_source").alias("_source"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sources.withColumn("_w", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn))
    weighed = weighed.withColumn("_most", F.lit(float(most)) * F.col("source_size")).withColumn(
        "_stop", F.col("_most") / F.col("_w")
    )
    order = Window.orderBy("_stop", "_k")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stopped = F.coalesce(F.sum("_most").over(before), F.lit(0.0))
    total = F.sum("source_size").over(whole)
    leveled = weighed.withColumn("_level", (F.lit(float(share)) * total - stopped) / F.sum("_w").over(onward))
    level = F.first(F.when(F.col("_level") < F.col("_stop"), F.col("_level")), ignorenulls=True).over(whole)
    return leveled.withColumn(
        "target", F.least(F.col("_most"), F.coalesce(F.col("_w") * level, F.col("_most")))
    ).select("_k", "source_size", "target")


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` and ``copies`` to every row of ``docs``.

    ``keep`` names the columns that come along; all if not given.  Without the text
    far less is moved.

    Within a source, documents are ordered by size, then by a hash.  Each expects
    ``target / source_size`` copies; these are prefix-summed, one random offset per
    source is added, and a document is emitted once per integer boundary its
    interval crosses.  The order makes neighbours alike in size, so a source's
    words come near its target.  Sums are decimals: partition bounds and reruns
    change nothing.

    The prefix sum runs on all executors: rows are range-partitioned and placed once
    in the shared folder; a row's sum is its position in the partition times what its
    source expects, shifted by the sums of the partitions before.  A hot source or size
    spreads by the hash.

    NULL and blank texts have size 0 and take part like others; a source of size 0
    has target 0 and is never taken.  Repeated rows are rows of their own.  An
    empty table gives an empty result.  Needs ``doc_id``, ``text``, ``source``;
    further columns pass through, whatever their names; only the four names that this
    adds are refused, as the result would have them twice (:func:`mixed_rows` takes them too).
    """
    names = list(docs.columns if keep is None else keep)
    clash = sorted({c.lower() for c in names} & set(_ADDED))
    if clash:
        raise ValueError(f"columns this operator adds are there already: {clash}")
    return _mixed(docs, weights, share, most, seed, names).select(*_carried(names), *_ADDED)


def _carried(names: Sequence[str]) -> list[Column]:
    """The columns ``names`` from a frame of :func:`_mixed`."""
    others = [n for n in names if n.lower() not in _READ]
    whole = dict(zip(others, unpacked(others), strict=True))
    return [whole.get(n, F.col(quoted(n))) for n in names]


def _mixed(docs: DataFrame, weights: Sequence[int], share: float, most: float, seed: str, keep: Sequence[str]) -> DataFrame:
    """What :func:`mix_sources` adds, beside the columns ``keep``: those that it reads
    under their names, all others in one struct, so that no name clashes."""
    others = [n for n in keep if n.lower() not in _READ]
    names = [n for n in keep if n.lower() in _READ] + ["_row"] * bool(others)
    docs = docs.select(*_READ, *([packed(others)] if others else []))
    # A key without NULL, so that joins and partitions treat NULL as one source.
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    sized = docs.withColumns(
        {
            "size": word_count(F.col("text")),
            "_k": key,
            "_source": F.col("source"),
            "_hash": F.md5(F.col("doc_id").cast("string")),
            "_tie": F.xxhash64("text"),
        }
    ).select(*names, "size", "_k", "_source", "_hash", "_tie")
    order = ["_k", "size", "_hash", "_tie"]
    placed = stored(
        sized.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright(F.col("_slot"), _POSITION_BITS)),
        "mix",
    )
    targets = source_targets(placed.select("_k", "_source", "size"), weights, share, most)
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    first = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("_k"))), 1, 7), 16, 10)
    offset = (first.cast("double") / F.lit(float(1 << 28))).cast(_EXACT)
    plan = targets.select(
        "_k", "source_size", "target", expected.cast("decimal(20,12)").alias("_e"), offset.alias("_base")
    )
    # One row per partition and source in it: what the partitions before hold.  A source's
    # rows lie side by side in a partition and all expect the same, so a row's sum
    # follows from its position, and no row is moved or sorted again.
    parts = placed.groupBy("_k", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_slot").alias("_first"))
    ahead = Window.partitionBy("_k").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = (F.col("_n").cast("decimal(18,0)") * F.col("_e")).cast(_EXACT)
    starts = parts.join(plan, "_k").withColumn(
        "_base", (F.coalesce(F.sum(held).over(ahead), F.lit(0)) + F.col("_base")).cast(_EXACT)
    )
    # As a stored table it has a size that Spark knows: small ones are broadcast, and the texts stay where they are.
    starts = stored(starts.drop("_n"), "mix-starts")
    position = (F.col("_slot") - F.col("_first") + 1).cast("decimal(18,0)")
    upto = (F.col("_base") + (position * F.col("_e")).cast(_EXACT)).cast(_EXACT)
    copies = (F.floor("_sum") - F.floor(F.col("_sum") - F.col("_e"))).cast("long")
    summed = placed.join(starts, ["_k", "_part"]).withColumn("_sum", upto)
    return summed.withColumn("copies", copies).select(*names, *_ADDED)


def mixed_rows(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "mix"
) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it, whatever its columns' names."""
    mixed = _mixed(docs, weights, share, most, seed, docs.columns)
    copies = F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies").cast("int")))
    return mixed.withColumn("copies", F.explode(copies)).select(*_carried(docs.columns))
