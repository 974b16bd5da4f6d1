"""Packing token sequences by minimum bin slack."""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sedimenta.llm.carried import returning
from sedimenta.session import stored

#: Id that ends a document.
END_ID = 0
#: Bytes of ids in one batch of a task's output.
_TOGETHER = 16_000_000
# Texts of these characters only take the faster of two encoders, which agree on
# them; any other text, and one that holds a special token, takes the other.
_COMMON = re.compile(r"[\t\n\r\x20-\x7eA-Za-zÀ-ÖØ-öø-ɏ¡¿«»§°‐-―‘-‟…]*")


class Encoder:
    """Ids of whole texts as the tokenizer file defines them.

    The file is a byte-level BPE whose ids are merge ranks, so a ``tiktoken``
    encoding made from its own vocabulary gives the same ids several times faster.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the task has one core
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=False)
        letters = byte_letters()
        ranks = {
            bytes(letters[c] for c in token): rank for token, rank in vocabulary.items() if token not in self._special
        }
        self._fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if _COMMON.fullmatch(text) and not any(s in text for s in self._special):
            return np.array(self._fast.encode_ordinary(text), dtype="<u4")
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones are
    themselves, the others follow from code point 256 on in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


def tokenized_pieces(docs: DataFrame, path: str, longest: int, keep_ids: bool) -> DataFrame:
    """Pieces of at most ``longest`` ids, each with its number among the pieces of
    its length in its task (``_at``) and the task's number (``_part``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = Encoder(path), TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            rows, size = [], 0
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.append(encoder.ids(text.as_py() or ""), np.uint32(END_ID)).tobytes()
                total = len(ids) // 4
                start, piece = 0, 0
                end = total % longest or longest  # only the first piece may be shorter
                while start < total:
                    own, length = ids[4 * start : 4 * end], end - start
                    rows.append((doc.as_py(), piece, start, length, zlib.crc32(own), own if keep_ids else None, part, seen[length]))
                    seen[length] += 1
                    piece, start, end = piece + 1, end, end + longest
                size += len(ids)
                if size > _TOGETHER:
                    yield _pieces(rows)
                    rows, size = [], 0
            yield _pieces(rows)

    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, ids binary, _part int, _at long"
    names = columns.replace(",", "").split()[::2]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
    doc_kind = to_arrow_type(docs.schema["doc_id"].dataType)

    def _pieces(rows: list[tuple]) -> pa.RecordBatch:
        by_column = list(zip(*rows, strict=True)) or [()] * len(names)
        arrays = [pa.array(c, type=t) for c, t in zip(by_column, [doc_kind, *kinds], strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select("doc_id", "text").mapInArrow(returning(run), columns)


def fullest(first: int, available: dict[int, int], capacity: int) -> dict[int, int]:
    """The fullest bin that holds ``first``: how many of each length.

    Subset sums are bits of one integer; each group of equal lengths is offered in
    doubling bundles, and the sums before each bundle are kept for the way back.
    Long lengths come first, so short ones are left for later gaps.
    """
    room = capacity - first
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted(available, reverse=True):
        if length > room:
            continue
        left, bundle = min(available[length] - (length == first), room // length), 1
        while left > 0:
            take = min(bundle, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, bundle = left - take, bundle * 2
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    chosen = defaultdict(int, {first: 1})
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] += take
            at -= length * take
    return dict(chosen)


def bin_patterns(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Bins by minimum bin slack: pattern and how many bins follow it.

    The longest piece left opens a bin, subset sums fill it best, and the
    combination is taken as often as the counts allow.  The work depends on the
    number of lengths, not of pieces.
    """
    left, patterns = dict(counts), []
    while left:
        pattern = fullest(max(left), left, capacity)
        times = min(left[length] // n for length, n in pattern.items())
        for length, n in pattern.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
        patterns.append((pattern, times))
    return patterns


def slots(patterns: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """For each pattern and length in it: which pieces of that length go there, by
    number, and where they lie.  Sorted by length, then first number."""
    used, rows, base = defaultdict(int), [], 0
    for pattern, times in patterns:
        offset = 0
        for length, n in sorted(pattern.items(), reverse=True):
            rows.append((length, used[length], n, base, offset))
            used[length] += n * times
            offset += length * n
        base += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "each", "sequence", "offset"), table.T, strict=True))


def pack_documents(docs: DataFrame, path: str, longest: int = 2048, keep_ids: bool = False) -> DataFrame:
    """Place the tokens of every document in sequences of at most ``longest``.

    Returns one row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset`` and, with ``keep_ids``, ``ids`` (little-endian unsigned
    32-bit); ordering a sequence's pieces by ``offset`` and joining their ids
    gives its content.  A document's ids end with id 0; a NULL or empty text is
    that id alone.  Repeated rows are packed each; an empty table gives an empty
    result.  ``path`` is the tokenizer's file.  Only ``doc_id`` and ``text`` are
    read.

    Tokens are written once to the shared folder.  The driver gets one count per
    length (``longest`` rows at most) and plans bins for lengths; pieces are
    numbered within their length from per-task counts and find their place by
    that number.
    """
    pieces = stored(tokenized_pieces(docs, path, longest, keep_ids), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = slots(bin_patterns(counts, longest))
    per_task = pieces.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_task.select("_part", "length", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        wide = 1 << 45  # pieces of one length stay below this
        at = np.searchsorted(plan["length"] * wide + plan["first"], length.to_numpy() * wide + number.to_numpy(), "right") - 1
        nth = number.to_numpy() - plan["first"][at]
        each = plan["each"][at]
        return pd.DataFrame(
            {"sequence_id": plan["sequence"][at] + nth // each, "offset": plan["offset"][at] + nth % each * length.to_numpy()}
        )

    numbered = pieces.join(starts, ["_part", "length"]).withColumn("_place", place("length", F.col("_start") + F.col("_at")))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if keep_ids else [])
    return numbered.select(*kept, "_place.sequence_id", "_place.offset")
