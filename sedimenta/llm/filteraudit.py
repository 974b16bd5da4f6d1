"""What each of several filters does in every order, from one count per pattern of failures."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.session import stored

_BLANKS = r"[\x20\x09-\x0D]+"
#: The filters' letters, in order of their bits.
FILTERS = "ABCDE"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, _BLANKS), "")


def own_failures(text: Column) -> list[Column]:
    """Whether a text fails A (under 200 words), B (under half of its words distinct),
    C (over 3 % capitals) and D (holds a mark-up character)."""
    words = F.size(_words(text)).cast("long")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [
        words < 200,
        100 * F.size(F.array_distinct(_words(text))).cast("long") < 50 * words,
        100 * capitals.cast("long") > 3 * F.length(text).cast("long"),
        text.rlike(r"[#$%&*|]"),
    ]


def failure_masks(docs: DataFrame, part: Column) -> DataFrame:
    """``doc_id``, ``part`` and ``mask`` of every row: bit ``i`` is set where it fails ``FILTERS[i]``.

    E fails where a row of a smaller ``doc_id`` has the same text; a row without a
    ``doc_id`` is neither a copy nor an original.  A NULL text counts as empty.

    Only ids, parts, masks and digests move.  Copies are found by joining the
    smallest id of each text back on digest and id together, so a text that a third
    of all rows share is spread over all tasks.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    bits = [F.shiftleft(failed.cast("int"), i) for i, failed in enumerate(own_failures(text))]
    narrow = stored(
        docs.select(
            "doc_id",
            part.alias("part"),
            sum(bits[1:], bits[0]).alias("mask"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        ),
        "failures",
    )
    firsts = narrow.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    joined = narrow.join(firsts, ["digest", "doc_id"], "left")
    return joined.select("doc_id", "part", (F.col("mask") + F.when(copy, 1 << 4).otherwise(0)).alias("mask"))


def gray_states(cells: np.ndarray) -> np.ndarray:
    """Survivors of every set of filters, from counts by failure mask.

    ``cells[mask]`` holds counts (one or several columns); row ``s`` of the result
    is what is left when the filters of the bits of ``s`` have run.  The sets
    are walked in Gray code order, so each step switches one filter: cells that
    fail it count one active failure more or less, and the survivors change by
    the cells whose counter leaves or reaches zero.
    """
    masks = np.arange(len(cells))
    failing = np.zeros(len(cells), dtype=np.int64)
    states = np.zeros_like(cells)
    left = states[0] = cells.sum(axis=0)
    active = 0
    for step in range(1, len(cells)):
        bit = step & -step
        active ^= bit
        hit = (masks & bit) != 0
        if active & bit:
            left = left - cells[hit & (failing == 0)].sum(axis=0)
            failing[hit] += 1
        else:
            failing[hit] -= 1
            left = left + cells[hit & (failing == 0)].sum(axis=0)
        states[active] = left
    return states


def order_rows(cells: np.ndarray, names: str) -> list[tuple]:
    """One row per order of the filters and step in it, from counts of documents and
    their marks by failure mask: (order, step, kept, removed, redundant, unique_fails, lost by
    each mark..., shapley)."""
    states = gray_states(cells)
    masks = np.arange(len(cells))
    fails = [int(cells[(masks >> i & 1) == 1, 0].sum()) for i in range(len(names))]
    rows, whole = [], [0] * len(names)
    for order in permutations(range(len(names))):
        done = 0
        for step, i in enumerate(order, 1):
            gone = states[done] - states[done | 1 << i]
            done |= 1 << i
            removed = int(gone[0])
            whole[i] += removed
            label = "".join(names[f] for f in order)
            rows.append((i, label, step, int(states[done][0]), removed, fails[i] - removed, int(cells[1 << i, 0]), *map(int, gone[1:])))
    return [(*row[1:], whole[row[0]]) for row in rows]


def audit_filters(masked: DataFrame, marks: Mapping[str, Column], names: str = FILTERS) -> DataFrame:
    """What each filter does at each step of every order, for each ``part`` of ``masked``.

    ``masked`` has ``part`` and ``mask`` (bit ``i``: the row fails ``names[i]``);
    ``marks`` are conditions whose removed rows are counted as well.  Returns
    ``part``, ``filter_order``, ``step`` (from 1), ``kept``, ``removed``,
    ``redundant`` (fails the step's filter, removed earlier), ``unique_fails``
    (fails this filter only), one count per mark, and ``shapley`` (rows the filter
    removed, summed over all orders).

    Rows are counted by part and mask before anything moves; each part's counts
    (one per mask) are then walked in one task.  A NULL part is the empty string;
    repeated rows count each; an empty table has no part.  The result has n! x n rows
    a part, so this is for a handful of filters.
    """
    part = F.coalesce(F.col("part"), F.lit("")).alias("part")
    ones = [F.coalesce(m, F.lit(False)).cast("long").alias(n) for n, m in marks.items()]
    cells = (
        masked.select(part, "mask", *ones)
        .groupBy("part", "mask")
        .agg(F.count(F.lit(1)).alias("_n"), *[F.sum(n).alias(n) for n in marks])
    )
    counted = ["_n", *marks]
    columns = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", *marks, "shapley"]
    longs = ", ".join(f"`{c}` long" for c in columns[2:])

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros((1 << len(names), len(counted)), dtype=np.int64)
        table[pdf["mask"].to_numpy()] = pdf[counted].to_numpy()
        rows = pd.DataFrame(order_rows(table, names), columns=columns)
        rows.insert(0, "part", pdf["part"].iloc[0])
        return rows

    return cells.groupBy("part").applyInPandas(walk, f"part string, filter_order string, step int, {longs}")


def labelled(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """``masked`` with ``good`` and ``toxic``: whether any row of ``labels`` for its
    ``doc_id`` has ``quality`` 1, or ``toxic`` 1.  A NULL ``doc_id`` has none."""
    marks = labels.groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    return masked.join(marks, "doc_id", "left")
