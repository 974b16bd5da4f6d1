"""Token ids in compressed binary files with one prefix code for all, read back block by block.

A file holds a stretch of the corpus's ids, in order of ``doc_id``:

- ``TOKENS01``
- the code: zlib-compressed code lengths, one byte per id of the vocabulary
- blocks of equally many ids (the last may be shorter), whatever documents they are of: the
  bit at which every so-many-th id starts (32 bits each), then the codes
- the documents: an Arrow stream of ``doc_id`` and ``n_tokens``
- the blocks: place, bytes, number of ids and CRC-32 of each, 64 bits each
- places and sizes of these parts and the numbers above, 64 bits each; ``TOKENS01``

All numbers are little-endian; codes are written highest bit first.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import uuid
import zlib
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sedimenta.llm.packing import byte_letters
from sedimenta.llm.prefixcode import PrefixCode, code_lengths
from sedimenta.session import stored

#: Id that ends a document.
END_ID = 2
_MAGIC = b"TOKENS01"
_TAIL = "<8Q8s"  # code, documents, blocks: place and bytes; ids a block and a checkpoint
_TOGETHER = 1 << 20  # ids decoded at once
_WORDS, _PIECES_KEPT = 1 << 20, 1 << 19  # words, and pieces of words, whose ids are remembered

# The settings of the word tokenizer, under which a blank always ends a word and is dropped.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SETTINGS = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": _PIECES}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False},
        ],
    },
}
_NO_MATTER = ("trim_offsets",)  # concerns places, not ids
# Characters that no normal form changes and whose small letters everyone agrees on.
_SOLID = ~np.isin(np.arange(256), [9, 10, 13, 32])  # bytes that are no blank
_COMMON = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-ɏ¡¿«»§°‐-―‘-‟…]*")


class WordEncoder:
    """Ids of whole texts by the ``tokenizers`` library, as little-endian bytes.

    Where the tokenizer's settings drop blanks and never look across one, each
    different word is encoded once and its ids are kept.  A word of common characters
    is cut as the settings say and the library's model gets its pieces, which are kept as well;
    any other word goes through the whole library.  With other settings so does every whole text.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the task has one core
        import regex
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        settings = json.loads(self._tokenizer.to_str())
        kept = {name: settings[name] for name in ("normalizer", "pre_tokenizer")}
        kept = json.loads(json.dumps(kept), object_hook=lambda d: {k: d[k] for k in d if k not in _NO_MATTER})
        self._by_word = kept == _SETTINGS
        special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        # A word that holds the first character of a special token might hold the token.
        plain = [c for c in map(chr, range(0x21, 0x2030)) if _COMMON.fullmatch(c) and c not in {t[0] for t in special}]
        self._plain = re.compile(f"[{re.escape(''.join(plain))}]*").fullmatch
        self._cut = regex.compile(rf"\n|{_PIECES}").findall
        self._letters = {b: c for c, b in byte_letters().items()}
        self.dtype = id_type(self._tokenizer.get_vocab_size())
        self._words, self._pieces = _kept(f"{path} words"), _kept(f"{path} pieces")

    def ids(self, texts: pa.Array, end_id: int) -> pa.Array:
        """The ids of every text and ``end_id``, as bytes; a NULL text is empty."""
        if not self._by_word:
            return pa.array([self._encode(text or "") + self._packed([end_id]) for text in texts.to_pylist()], pa.binary())
        words, counts = _split(texts)
        coded = words.dictionary_encode()
        names, which = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        known = list(map(self._words.get, names))
        if new := [name for name, ids in zip(names, known, strict=True) if ids is None]:
            if len(self._words) + len(new) > _WORDS:
                self._words.clear()
                new = names
                known = [None] * len(names)
            self._learn(new)
            known = [self._words[name] if ids is None else ids for name, ids in zip(names, known, strict=True)]
            for name in new:
                if len(name) > 64:
                    del self._words[name]
        # One more word, after the last of each text, has the end id.
        ends = np.cumsum(counts)
        places = np.insert(which, ends, len(known))
        found = pa.array([*known, self._packed([end_id])], pa.large_binary()).take(pa.array(places))
        _, offsets, data = found.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])]
        return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(at), data])

    def _learn(self, words: list[str]) -> None:
        plain = [word for word in words if self._plain(word)]
        if len(plain) < len(words):
            for word in set(words).difference(plain):
                self._words[word] = self._encode(word)
        if not plain:
            return
        small = "\n".join(plain).lower().split("\n")
        # Words of letters are one piece each; the others are cut in one go, a line each.
        mixed = [i for i, word in enumerate(small) if not word.isalpha()]
        pieces = self._cut("\n".join([small[i] for i in mixed]))
        seen = {word for word in small if word.isalpha()}
        seen.update(pieces)
        new = seen.difference(self._pieces)
        if len(self._pieces) + len(new) > _PIECES_KEPT:
            self._pieces.clear()
            new = seen
        tokenize, made = self._model.tokenize, struct.pack
        letter = "H" if self.dtype.itemsize == 2 else "I"
        for piece in new:
            letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self._letters)
            ids = [token.id for token in tokenize(letters)]
            self._pieces[piece] = made(f"<{len(ids)}{letter}", *ids)
        self._words.update(zip(plain, map(self._pieces.get, small), strict=True))
        at = 0
        for i in mixed:
            own = []
            while at < len(pieces) and pieces[at] != "\n":
                own.append(self._pieces[pieces[at]])
                at += 1
            self._words[plain[i]] = b"".join(own)
            at += 1
        for piece in new:
            if len(piece) > 64:
                del self._pieces[piece]

    def _encode(self, text: str) -> bytes:
        return self._packed(self._tokenizer.encode(text, add_special_tokens=False).ids if text else [])

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.dtype.itemsize == 2 else 'I'}", *ids)


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words between blanks of all texts, and how many each text has."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, dtype=np.uint8)
    at = at - at[0]
    solid = _SOLID[data]
    kept = np.zeros(len(data) + 1, dtype=np.int64)  # bytes before each place, without blanks
    np.cumsum(solid, out=kept[1:])
    stops = np.append(~solid, False)
    stops[at] = True
    bounds = kept[stops]
    bounds = bounds[np.concatenate([[True], bounds[1:] != bounds[:-1]])]
    counts = np.diff(np.searchsorted(bounds, kept[at]))
    buffers = [None, pa.py_buffer(bounds), pa.py_buffer(data[solid])]
    return pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, buffers), counts


def _kept(name: str) -> dict[str, bytes]:
    """A table that stays while the worker process does, from one task to the next."""
    place = sys.modules.setdefault("_sedimenta_kept", ModuleType("_sedimenta_kept"))
    return vars(place).setdefault(name, {})


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()


def slices_of(texts: pa.Array, most: int) -> Iterator[range]:
    """Runs of texts of about ``most`` bytes; a longer text is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(False)
    first = size = 0
    for i, own in enumerate(sizes.tolist()):
        if size and size + own > most:
            yield range(first, i)
            first, size = i, 0
        size += own
    if first < len(sizes):
        yield range(first, len(sizes))


def tokenized(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """``doc_id``, ``ids`` (bytes) of every row, and its place (``_part``, ``_at``) for ties."""
    kind = docs.schema["doc_id"].dataType
    arrow = pa.schema([("doc_id", to_arrow_type(kind)), ("ids", pa.binary()), ("_part", pa.int32()), ("_at", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = WordEncoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for run in slices_of(batch.column(1), 4_000_000):
                ids = encoder.ids(batch.column(1).slice(run.start, len(run)), end_id)
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(run.start, n).cast(arrow.field(0).type),
                        ids.cast(pa.binary()),
                        pa.array([part] * n, pa.int32()),
                        pa.array(np.arange(seen, seen + n)),
                    ],
                    schema=arrow,
                )
                seen += n

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind.simpleString()}, ids binary, _part int, _at long")


def id_counts(tokens: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs.  Tasks count first; the driver gets one row per id of the
    vocabulary at most."""
    dtype = id_type(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=dtype)
            counts += np.bincount(ids, minlength=vocabulary)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["id", "n"])

    rows = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(vocabulary, dtype=np.int64)
    counts[rows["id"].to_numpy()] = rows["n"].to_numpy()
    return counts


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    return pyarrow.fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


class TokenFileWriter:
    """One file, written from front to back in the memory of a block."""

    def __init__(self, stream, code: PrefixCode, dtype: np.dtype, block_ids: int, checkpoint_ids: int):
        self._stream, self._code, self._dtype = stream, code, dtype
        self._block_ids, self._checkpoint_ids = block_ids, checkpoint_ids
        self._open, self._open_ids, self._blocks, self.n_ids = [], 0, [], 0
        stream.write(_MAGIC)
        self._code_part = self._part(zlib.compress(code.lengths.astype(np.uint8).tobytes()))

    def _part(self, data: bytes) -> tuple[int, int]:
        place = self._stream.tell()
        self._stream.write(data)
        return place, len(data)

    def add(self, ids: bytes) -> int:
        own = np.frombuffer(ids, dtype=self._dtype)
        self._open.append(own)
        self._open_ids += len(own)
        self.n_ids += len(own)
        if self._open_ids >= self._block_ids:
            self._flush(self._open_ids // self._block_ids * self._block_ids)
        return len(own)

    def _flush(self, upto: int) -> None:
        ids = np.concatenate(self._open) if self._open else np.empty(0, dtype=self._dtype)
        for at in range(0, upto, self._block_ids):
            block = ids[at : min(at + self._block_ids, upto)]
            codes, starts = self._code.encode(block, self._checkpoint_ids)
            data = starts.astype("<u4").tobytes() + codes
            self._blocks.append((*self._part(data), len(block), zlib.crc32(data)))
        self._open, self._open_ids = [ids[upto:]], len(ids) - upto

    def close(self, documents: pa.Table) -> None:
        self._flush(self._open_ids)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, documents.schema) as out:
            out.write_table(documents)
        index = self._part(sink.getvalue().to_pybytes())
        blocks = self._part(np.array(self._blocks, dtype="<u8").tobytes())
        self._stream.write(struct.pack(_TAIL, *self._code_part, *index, *blocks, self._block_ids, self._checkpoint_ids, _MAGIC))
        self._stream.close()


class TokenFile:
    """A file of ids, read by block."""

    def __init__(self, uri: str):
        system, path = file_system(uri)
        self._file = system.open_input_file(path)
        size = self._file.size()
        length = struct.calcsize(_TAIL)
        tail = struct.unpack(_TAIL, self._file.read_at(length, size - length))
        if tail[-1] != _MAGIC:
            raise ValueError(f"{uri} is not a whole token file")
        code, self._index, blocks = ((tail[i + 1], tail[i]) for i in (0, 2, 4))
        self._block_ids, self._checkpoint_ids = tail[6:8]
        self._code = PrefixCode(np.frombuffer(zlib.decompress(self._file.read_at(*code)), dtype=np.uint8))
        self._blocks = np.frombuffer(self._file.read_at(*blocks), dtype="<u8").reshape(-1, 4).astype(np.int64)
        self.n_ids = int(self._blocks[:, 2].sum())

    def documents(self) -> pa.Table:
        return pa.ipc.open_stream(self._file.read_at(*self._index)).read_all()

    def ids(self, first: int = 0, count: int | None = None) -> np.ndarray:
        """``count`` ids from the ``first`` on; reads only the blocks that hold them, and decodes
        from the checkpoint before."""
        last = self.n_ids if count is None else min(first + count, self.n_ids)
        if first >= last:
            return np.empty(0, dtype=np.uint32)
        every, at = self._checkpoint_ids, 0
        data, starts, counts, skip = [], [], [], 0
        for b in range(first // self._block_ids, (last - 1) // self._block_ids + 1):
            place, size, n, crc = (int(x) for x in self._blocks[b])
            raw = self._file.read_at(size, place)
            if len(raw) != size or zlib.crc32(raw) != crc:
                raise ValueError(f"block {b} is damaged")
            marks = -(-n // every)
            codes = np.frombuffer(raw, dtype=np.uint8)[4 * marks :]
            low, high = max(first - b * self._block_ids, 0), min(last - b * self._block_ids, n)
            own = np.arange(low // every, -(-high // every))
            skip = low % every if b == first // self._block_ids else skip
            data.append(codes)
            starts.append(np.frombuffer(raw, dtype="<u4", count=marks)[own].astype(np.int64) + 8 * at)
            counts.append(np.minimum(high - own * every, every))
            at += len(codes)
        return self._code.decode(np.concatenate(data), np.concatenate(starts), np.concatenate(counts))[skip:]

    def stretches(self, ids: int = _TOGETHER) -> Iterator[np.ndarray]:
        """All ids, whole blocks of about ``ids`` at a time."""
        step = max(ids // self._block_ids, 1) * self._block_ids
        for first in range(0, self.n_ids, step):
            yield self.ids(first, step)

    def close(self) -> None:
        self._file.close()


def write_token_files(
    docs: DataFrame,
    path: str,
    folder: str,
    end_id: int = END_ID,
    block_ids: int = 1 << 16,
    checkpoint_ids: int = 256,
    longest: int | None = None,
) -> DataFrame:
    """Write the ids of all texts, in ascending ``doc_id``, to token files under ``folder``.

    ``path`` is the tokenizer's file; ``end_id`` follows each document.  The code is
    the best one for the counts of all ids among those of at most ``longest`` bits (by
    default 16, or what the vocabulary needs).  Returns the files in order: ``part``,
    ``file``, ``n_docs``, ``n_tokens``, ``n_bytes``; also kept as ``folder/files``, by which
    :func:`read_token_files` reads.

    Ids are written once to the shared folder, counted there, range-partitioned by ``doc_id``
    (a repeated one is spread by its row's place) and encoded, one file per
    partition.  A file's name is its attempt's own, and only files that the stored list
    names count, so tasks may be repeated at any time.

    A NULL or empty text has the end id only; rows without ``doc_id`` come first; rows
    of one ``doc_id`` come in the order they were read.  An empty table gives an empty list.
    Only ``doc_id`` and ``text`` are read.
    """
    spark = docs.sparkSession
    vocabulary = max(vocabulary_size(path), end_id + 1)
    dtype = id_type(vocabulary)
    tokens = stored(tokenized(docs, path, end_id), "tokens")
    lengths = code_lengths(id_counts(tokens, vocabulary), longest or max(16, (vocabulary - 1).bit_length()))
    kind = to_arrow_type(docs.schema["doc_id"].dataType)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, writer, doc_ids, counts = TaskContext.get().partitionId(), None, [], []
        for batch in batches:
            if writer is None and len(batch):
                system, place = file_system(folder)
                system.create_dir(place, recursive=True)
                name = f"{part:08d}-{uuid.uuid4().hex}.tokens"
                stream = system.open_output_stream(f"{place}/{name}")
                writer = TokenFileWriter(stream, PrefixCode(lengths), dtype, block_ids, checkpoint_ids)
            doc_ids.append(batch.column(0).cast(kind))
            counts += [writer.add(ids.as_buffer()) for ids in batch.column(1)]
        if writer is not None:
            documents = pa.table({"doc_id": pa.chunked_array(doc_ids, kind), "n_tokens": pa.array(counts, pa.int64())})
            writer.close(documents)
            size = system.get_file_info(f"{place}/{name}").size
            rows = [[part], [name], [len(counts)], [writer.n_ids], [size]]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            names = ["part", "file", "n_docs", "n_tokens", "n_bytes"]
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], names=names)

    order = ["doc_id", "_part", "_at"]
    ranged = tokens.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
    files = ranged.mapInArrow(write, "part int, file string, n_docs long, n_tokens long, n_bytes long")
    files.write.parquet(f"{folder}/files")
    return spark.read.schema(files.schema).parquet(f"{folder}/files")


def read_token_files(spark: SparkSession, folder: str, doc_id: str = "long", keep_ids: bool = False) -> DataFrame:
    """One row per document of the token files under ``folder``: ``doc_id`` (of the given type),
    ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32`` (of its ids as
    little-endian unsigned 32-bit numbers) and, with ``keep_ids``, ``ids`` (those bytes).

    A task decodes a file, some blocks at a time.  Files are dealt one to a partition;
    what lies before each follows from the list of files (one row a file, summed in one task).
    """
    files = spark.read.parquet(f"{folder}/files")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("part", "file", F.coalesce(F.sum("n_tokens").over(ahead), F.lit(0)).alias("base"))
    kind = spark.createDataFrame([], f"doc_id {doc_id}").schema
    arrow = [to_arrow_type(kind[0].dataType), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * keep_ids
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * keep_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(1), batch.column(2), strict=True):
                yield from _decoded(f"{folder.rstrip('/')}/{name.as_py()}", base.as_py(), arrow, names)

    columns = f"doc_id {doc_id}, start long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids
    return placed.repartitionByRange(max(files.count(), 1), "part").mapInArrow(read, columns)


def _decoded(uri: str, base: int, kinds: list[pa.DataType], names: list[str]) -> Iterator[pa.RecordBatch]:
    """A file's documents, in batches: each ends in the stretch that its row comes with."""
    file = TokenFile(uri)
    documents = file.documents()
    counts = documents["n_tokens"].to_numpy()
    ends = np.cumsum(counts)
    doc, crc, held, low = 0, 0, [], 0  # the open document: its checksum and ids so far
    for ids in file.stretches():
        rows, first = [], doc
        high = low + len(ids)
        raw = ids.astype("<u4").tobytes()
        while doc < len(ends) and ends[doc] <= high:
            start = int(ends[doc] - counts[doc])
            own = raw[4 * max(start - low, 0) : 4 * (int(ends[doc]) - low)]
            rows.append((base + start, int(counts[doc]), zlib.crc32(own, crc), b"".join([*held, own]) if len(names) > 4 else None))
            doc, crc, held = doc + 1, 0, []
        if doc < len(ends):
            own = raw[4 * max(int(ends[doc] - counts[doc]) - low, 0) :]
            crc = zlib.crc32(own, crc)
            if len(names) > 4:
                held.append(own)
        low = high
        if rows:
            columns = list(zip(*rows, strict=True))[: len(names) - 1]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds[1:], strict=True)]
            own_ids = documents["doc_id"].slice(first, doc - first).combine_chunks().cast(kinds[0])
            yield pa.RecordBatch.from_arrays([own_ids, *arrays], names=names)
    file.close()
