"""Removal of repeated substrings by suffix sorting in blocks over a difference cover."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.texts import RollingHash
from sedimenta.session import stored

_U = np.uint64
#: Bytes of an anchor: of a string's stretches of this length, the one of least hash.
ANCHOR = 16
#: Period of the difference cover and its residues: any two residues have a common
#: shift below the period that takes both into the cover.
PERIOD, COVER = 13, (0, 1, 3, 9)
#: By residue, the distance to the next covered position.
_SHIFT = np.array([min((c - r) % PERIOD for c in COVER) for r in range(PERIOD)])
_POSITION_BITS = 17
_CHUNK = 1 << 16
#: Masks that keep the first 0 to 8 bytes of a word.
_KEEP = np.array([((1 << 64) - 1) ^ ((1 << (64 - 8 * n)) - 1) for n in range(9)], dtype=np.uint64)
_NO_ID = np.iinfo(np.int64).max


class Windows:
    """The strings of ``length`` bytes in a pack of documents, in runs of
    neighbours that have the same anchor.

    Equal strings have equal anchors at equal places, wherever they lie, so a
    string is only ever compared with those of its anchor.
    """

    def __init__(self, data: np.ndarray, ends: np.ndarray, length: int):
        """``ends``: where each document of the pack ends.

        Strings are read in stretches of bounded length and only beginnings of runs are
        kept, about one in seventeen places, so a very long document takes little beside its bytes.
        """
        kmers = length - ANCHOR + 1
        total = max(0, len(data) - length + 1)
        low = (1 << _POSITION_BITS) - 1
        begins = np.unique(np.concatenate([[0], ends[:-1]]).astype(np.int64)) if len(ends) else np.empty(0, np.int64)
        places, anchors, hashes, before = [], [], [], -1
        for start in range(0, total, _CHUNK):
            n = min(_CHUNK, total - start)
            value = RollingHash(data[start : start + n + length - 1]).every(ANCHOR) & ~_U(low)
            value |= np.arange(len(value), dtype=_U)  # of equal hashes the leftmost
            width = 1
            while width < kmers:
                step = min(width, kmers - width)
                value = np.minimum(value[:-step], value[step:])
                width += step
            anchor = (value & _U(low)).astype(np.int64) + start
            fresh = np.empty(n, bool)
            fresh[0], fresh[1:] = anchor[0] != before, anchor[1:] != anchor[:-1]
            fresh[begins[np.searchsorted(begins, start) : np.searchsorted(begins, start + n)] - start] = True
            at = np.flatnonzero(fresh)
            places.append(at + start)
            anchors.append(anchor[at])
            hashes.append(value[at] >> _U(_POSITION_BITS))
            before = anchor[-1]
        first = np.concatenate([np.empty(0, np.int64), *places])
        anchor = np.concatenate([np.empty(0, np.int64), *anchors])
        value = np.concatenate([np.empty(0, _U), *hashes])
        doc = np.searchsorted(ends, first, side="right")
        # Strings that cross a document's end follow its last run.
        inside = first + length <= ends[doc]
        first, anchor, value, doc = first[inside], anchor[inside], value[inside], doc[inside]
        stop = np.concatenate([first[1:], [total]])[: len(first)]
        last = np.minimum(stop, ends[doc] - length + 1)
        self.start, self.count = first, last - first
        self.doc, self.value, self.offset = doc, value, anchor - first


class Contents:
    """The distinct contents of a pack's runs with shared anchors, in a fixed order:
    by bucket, then by hash of the content."""

    def __init__(self, data: np.ndarray, windows: Windows, shared: np.ndarray, ids: np.ndarray, buckets: int, length: int):
        runs = np.flatnonzero(np.isin(windows.value, shared, assume_unique=False))
        start, count = windows.start[runs], windows.count[runs]
        size = count + length - 1
        key = _content_hash(data, start, size) ^ (windows.offset[runs].astype(_U) << _U(56))
        bucket = (windows.value[runs] % _U(buckets)).astype(np.int64)
        order = np.lexsort((start, key, bucket))
        runs, start, count, size, key, bucket = (a[order] for a in (runs, start, count, size, key, bucket))
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (bucket[1:] != bucket[:-1])])[: len(key)]
        first = np.flatnonzero(fresh)
        self.start, self.doc, self.windows = start, windows.doc[runs], count
        self.content = np.cumsum(fresh) - 1  # of each run
        owner = ids[self.doc]
        self.first, self.key, self.bucket = first, key[first], bucket[first]
        self.least = np.minimum.reduceat(owner, first) if len(first) else owner
        self.most = np.maximum.reduceat(owner, first) if len(first) else owner
        self.value, self.offset = windows.value[runs][first], windows.offset[runs][first]
        self.size = size[first]


def _content_hash(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    words = _words(data, start, size, 11)
    seeds = np.random.default_rng(41).integers(0, 1 << 63, 11, dtype=_U) * _U(2) + _U(1)
    out = size.astype(_U)
    for k in range(words.shape[1]):
        out = (out ^ words[:, k]) * seeds[k]
        out ^= out >> _U(29)
    return out


def _words(data: np.ndarray, start: np.ndarray, size: np.ndarray | int, n: int) -> np.ndarray:
    """The ``n`` big-endian 8-byte words from each start on, zero beyond ``size``."""
    padded = np.concatenate([data, np.zeros(8 * n + 8, np.uint8)])
    # A word begins at every byte, so words are read where they lie.
    word_at = np.ndarray((len(padded) - 7,), ">u8", padded, strides=(1,))
    out = np.empty((len(start), n), _U)
    for k in range(n):
        used = np.clip(size - 8 * k, 0, 8)
        keep = _KEEP[used]
        out[:, k] = word_at[start + 8 * k].astype(_U) & keep
    return out


def equal_strings(text: np.ndarray, begin: np.ndarray, anchor: np.ndarray, windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order and classes of the strings of one block.

    ``text`` joins the block's contents; ``begin`` is where each starts, ``anchor``
    the anchor's place in it and ``windows`` how many strings of ``length`` bytes start
    in it.  Positions count from the anchor, modulo the cover's period.  Covered positions
    alone are sorted by their bytes; every other suffix is its few bytes up to the
    next covered position, then that position's rank, so long ties are never
    compared again.  Returns the order of all strings and, in that order, whether
    each begins a new class of equal strings.
    """
    total = int(windows.sum())
    content = np.repeat(np.arange(len(begin)), windows)
    nth = np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows)
    place = begin[content] + nth
    residue = (nth - anchor[content]) % PERIOD
    shift = _SHIFT[residue]
    target = place + shift
    covered = np.zeros(len(text) + 1, np.int64)
    covered[target] = 1
    sample = np.flatnonzero(covered)
    bytes_here = _words(text, sample, length, -(-length // 8))
    by_bytes = np.lexsort(bytes_here.T[::-1])
    ordered = bytes_here[by_bytes]
    # Per depth that some residue needs: the class of each covered position's first bytes.
    at = np.cumsum(covered)[target] - 1
    klass = np.empty(total, np.int64)
    for s in range(int(_SHIFT.max()) + 1):
        here = shift == s
        if not here.any():
            continue
        changes = np.zeros(len(sample), bool)
        depth = length - s
        for k in range(ordered.shape[1]):
            used = min(8, max(0, depth - 8 * k))
            if used:
                word = ordered[:, k] >> _U(8 * (8 - used))
                changes[1:] |= word[1:] != word[:-1]
        number = np.empty(len(sample), np.int64)
        number[by_bytes] = np.cumsum(changes)
        klass[here] = number[at[here]]
    # The few bytes leave the low bits free for the residue.
    head = _words(text, place, shift, 1)[:, 0] | residue.astype(_U)
    by_head = np.argsort(head)
    ordered_head = head[by_head]
    rank = np.zeros(total, np.int64)
    rank[by_head[1:]] = np.cumsum(ordered_head[1:] != ordered_head[:-1])
    both = (rank << 32) | klass  # a block holds fewer than 2**31 of either
    order = np.argsort(both)
    both = both[order]
    new = np.ones(total, bool)
    new[1:] = both[1:] != both[:-1]
    return order, new


def _packed(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array).tobytes())


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


_PACK = "pack long, ids binary, ends binary, text binary"


def _make_packs(pack_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = (text or "").encode()
                if size and size + len(data) > pack_bytes:
                    yield pack(part, made, ids, texts)
                    ids, texts, size, made = [], [], 0, made + 1
                ids.append(doc)
                texts.append(data)
                size += len(data)
        if ids:
            yield pack(part, made, ids, texts)

    def pack(part: int, made: int, ids: list, texts: list[bytes]) -> pa.RecordBatch:
        known = np.array([_NO_ID if i is None else i for i in ids], np.int64)
        ends = np.cumsum([len(t) for t in texts]).astype(np.int64)
        text = zstandard.ZstdCompressor(level=1).compress(b"".join(texts))
        arrays = [pa.array([(part << 32) + made]), *(pa.array([b], pa.binary()) for b in (_packed(known), _packed(ends), text))]
        return pa.RecordBatch.from_arrays(arrays, names=["pack", "ids", "ends", "text"])

    return run


def _open_pack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _unpacked(row["ids"], "<i8"), _unpacked(row["ends"], "<i8"), _unpacked(row["text"], "u1")


def _short(values: np.ndarray) -> bytes:
    """The lower six bytes of 47-bit values."""
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _long(data: bytes) -> np.ndarray:
    six = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return np.hstack([six, np.zeros((len(six), 2), np.uint8)]).view("<u8")[:, 0]


def repeated_spans(docs: DataFrame, length: int = 50, pack_bytes: int = 2_000_000) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``spans`` and ``kept`` of every document.

    Texts are UTF-8 bytes.  A byte is removed if a string of ``length`` bytes over
    it also starts in a document of a smaller id; strings are judged on the
    input and never cross documents.  ``spans`` are the maximal removed runs
    (start, end), ``kept`` the remaining bytes.  NULL texts are empty; short texts lose nothing.
    Equal ids never remove from one another; NULL ids come after all others.
    An empty table gives an empty result.  Only ``doc_id`` and ``text`` are read.

    1. Documents are written to the shared folder in packs of bounded size.
    2. Each pack sends its distinct anchors to hash buckets, which send back those
       that more than one document may hold.
    3. Each pack sends the distinct contents around shared anchors, with the smallest
       id that has them, to suffix buckets.  One content per pack is what moves,
       however many documents hold it.
    4. A bucket's suffixes are sorted, and every string learns the smallest id that has it.
    5. Each pack gets those ids back for its contents and marks its documents.
    """
    packs = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_make_packs(pack_bytes), _PACK), "packs")
    buckets = max(64, packs.select("pack").count() // 4)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                _, ends, data = _open_pack(row)
                windows = Windows(data, ends, length)
                pairs = np.unique(np.stack([windows.value, windows.doc.astype(_U)], axis=1), axis=0) if len(windows.value) else np.empty((0, 2), _U)
                values, held = np.unique(pairs[:, 0], return_counts=True)
                bucket = (values % _U(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                values, held, bucket = values[order], held[order] > 1, bucket[order]
                edges = np.searchsorted(bucket, np.arange(buckets + 1))
                full = np.flatnonzero(np.diff(edges))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full.astype(np.int32)),
                        pa.array(np.full(len(full), row["pack"], np.int64)),
                        pa.array([_short(values[edges[b] : edges[b + 1]]) for b in full], pa.binary()),
                        pa.array([np.packbits(held[edges[b] : edges[b + 1]]).tobytes() for b in full], pa.binary()),
                    ],
                    names=["bucket", "pack", "anchors", "several"],
                )

    def meeting(table: pa.Table) -> pa.Table:
        lists = [_long(b) for b in table.column("anchors").to_pylist()]
        sizes = [len(v) for v in lists]
        several = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(table.column("several").to_pylist(), sizes, strict=True)]
        values = np.concatenate(lists)
        _, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
        shared = (counts + np.bincount(inverse, np.concatenate(several)) > 1)[inverse]
        edges = np.concatenate([[0], np.cumsum(sizes)])
        back = [_short(values[a:b][shared[a:b]]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return pa.table({"pack": table.column("pack"), "shared": pa.array(back, pa.binary())}).filter(pa.array([len(b) > 0 for b in back]))

    shared = stored(
        packs.mapInArrow(anchors, "bucket int, pack long, anchors binary, several binary")
        .groupBy("bucket")
        .applyInArrow(meeting, "pack long, shared binary"),
        "shared-anchors",
    )

    def contents_of(row: dict, known: list[bytes]) -> tuple[Contents, np.ndarray, np.ndarray, np.ndarray]:
        ids, ends, data = _open_pack(row)
        values = np.concatenate([np.empty(0, _U), *[_long(b) for b in known]])
        return Contents(data, Windows(data, ends, length), values, ids, buckets, length), ids, ends, data

    def sending(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: dict[str, list] = {k: [] for k in ("bucket", "pack", "key", "value", "offset", "windows", "least", "most", "text")}
        for row in left.to_pylist() if right.num_rows else []:
            c, _, _, data = contents_of(row, right.column("shared").to_pylist())
            edges = np.searchsorted(c.bucket, np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(edges)):
                part = slice(edges[b], edges[b + 1])
                own = c.first[part]
                rows["bucket"].append(int(b))
                rows["pack"].append(row["pack"])
                for name, array, kind in (("key", c.key, "<u8"), ("offset", c.offset, "u1"), ("least", c.least, "<i8"), ("most", c.most, "<i8")):
                    rows[name].append(_packed(array[part].astype(kind)))
                rows["windows"].append(_packed(c.windows[own].astype("u1")))
                rows["text"].append(_packed(data[_stretches(c.start[own], c.size[part])]))
        del rows["value"]
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 6]
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(rows.items(), kinds, strict=True)})

    def sorting(table: pa.Table) -> pa.Table:
        def joined(name: str, kind: str) -> tuple[np.ndarray, list[int]]:
            parts = [_unpacked(b, kind) for b in table.column(name).to_pylist()]
            return np.concatenate(parts), [len(p) for p in parts]

        (key, sizes), (offset, _), (count, _) = joined("key", "<u8"), joined("offset", "u1"), joined("windows", "u1")
        (least, _), (most, _), (text, _) = joined("least", "<i8"), joined("most", "<i8"), joined("text", "u1")
        size = count.astype(np.int64) + length - 1
        begin = np.cumsum(size) - size
        # Equal contents of several packs are sorted once.
        _, one, inverse = np.unique(key, return_index=True, return_inverse=True)
        smallest = np.full(len(one), _NO_ID)
        np.minimum.at(smallest, inverse, least)
        count_one = count[one].astype(np.int64)
        order, new = equal_strings(text, begin[one], offset[one].astype(np.int64), count_one, length)
        owner = np.repeat(smallest, count_one)[order]
        lowest = np.minimum.reduceat(owner, np.flatnonzero(new)) if len(owner) else owner
        by_string = np.empty(len(owner), np.int64)
        by_string[order] = lowest[np.cumsum(new) - 1]
        # Back to each pack's contents: the smallest id per string, as runs of equal ids.
        first = (np.cumsum(count_one) - count_one)[inverse]
        strings = _stretches(first, count.astype(np.int64))
        content = np.repeat(np.arange(len(key)), count)
        lowest = by_string[strings]
        cut = np.concatenate([[True], (lowest[1:] != lowest[:-1]) | (content[1:] != content[:-1])])[: len(lowest)]
        run = np.flatnonzero(cut)
        runs = np.diff(np.concatenate([run, [len(lowest)]]))
        content, lowest = content[run], lowest[run]
        nth = run - (np.cumsum(count.astype(np.int64)) - count)[content]
        useful = lowest < most[content]
        content, lowest, nth, runs = content[useful], lowest[useful], nth[useful], runs[useful]
        edges = np.searchsorted(content, np.concatenate([[0], np.cumsum(sizes)]))
        base = np.cumsum(sizes) - sizes
        out = {"pack": [], "bucket": [], "content": [], "nth": [], "runs": [], "lowest": []}
        for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if a < b:
                out["pack"].append(table.column("pack")[i].as_py())
                out["bucket"].append(table.column("bucket")[i].as_py())
                for name, array, kind in (("content", content - base[i], "<u4"), ("nth", nth, "u1"), ("runs", runs, "u1"), ("lowest", lowest, "<i8")):
                    out[name].append(_packed(array[a:b].astype(kind)))
        kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds, strict=True)})

    def marking(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"doc_id": [], "n_bytes": [], "spans": [], "kept": []}
        known = [b for b in right.column("shared").to_pylist() if b is not None]
        found = [r for r in right.drop_columns(["shared"]).to_pylist() if r["lowest"] is not None]
        for row in left.to_pylist():
            c, ids, ends, data = contents_of(row, known)
            marks = np.zeros(len(data) + 1, np.int32)
            edges = np.searchsorted(c.bucket, np.arange(buckets + 1))
            run_edges = np.searchsorted(c.content, np.arange(len(c.first) + 1))
            for r in found:
                content = _unpacked(r["content"], "<u4").astype(np.int64) + edges[r["bucket"]]
                nth, runs, lowest = (_unpacked(r[k], t) for k, t in (("nth", "u1"), ("runs", "u1"), ("lowest", "<i8")))
                # Every occurrence of the content in this pack, for every run of its strings.
                times = run_edges[content + 1] - run_edges[content]
                at = _stretches(run_edges[content], times)
                lower = np.repeat(lowest, times) < ids[c.doc[at]]
                begin = (c.start[at] + np.repeat(nth.astype(np.int64), times))[lower]
                np.add.at(marks, begin, 1)
                np.add.at(marks, begin + np.repeat(runs.astype(np.int64), times)[lower] + length - 1, -1)
            gone = np.cumsum(marks, dtype=np.int32)[:-1] > 0
            start = 0
            for doc, end in zip(ids, ends, strict=True):
                own = gone[start:end]
                turns = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
                out["doc_id"].append(None if doc == _NO_ID else int(doc))
                out["n_bytes"].append(int(end - start))
                out["spans"].append([{"start": int(s), "end": int(e)} for s, e in zip(turns[::2], turns[1::2], strict=True)])
                out["kept"].append(data[start:end][~own].tobytes())
                start = end
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds, strict=True)})

    sent = (
        packs.groupBy("pack")
        .cogroup(shared.groupBy("pack"))
        .applyInArrow(sending, "bucket int, pack long, key binary, offset binary, windows binary, least binary, most binary, text binary")
    )
    back = "pack long, bucket int, content binary, nth binary, runs binary, lowest binary"
    lowest = sent.groupBy("bucket").applyInArrow(sorting, back)
    replies = shared.unionByName(lowest, allowMissingColumns=True)
    return (
        packs.groupBy("pack")
        .cogroup(replies.groupBy("pack"))
        .applyInArrow(marking, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    )


def _stretches(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of stretches, in order."""
    total = int(size.sum())
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(total)
