"""Fill-in-middle examples, cut at unit boundaries found by rank queries."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.carried import quoted, unused
from sedimenta.llm.wavelet import WaveletMatrix

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Classes of the bytes of a text.  A character is as many bytes that do not continue one.
CONTINUED, NEWLINE, BLANK, STOP, DIGIT, UPPER, LOWER, OTHER = range(8)
_LEVELS = 3
_CLASS = np.full(256, OTHER, dtype=np.uint8)
_CLASS[0x80:0xC0] = CONTINUED
_CLASS[list(b" \t\x0b\x0c\r")] = BLANK
_CLASS[ord("\n")] = NEWLINE
_CLASS[list(b".!?")] = STOP
_CLASS[ord("0") : ord("9") + 1] = DIGIT
_CLASS[ord("A") : ord("Z") + 1] = UPPER
_CLASS[ord("a") : ord("z") + 1] = LOWER

#: Units by the classes that end one; what follows the last end is a unit as well.
UNITS = {"line": (NEWLINE,), "sentence": (NEWLINE, STOP), "word": (NEWLINE, BLANK)}

_TOGETHER = 4_000_000  # bytes in one matrix; a longer text has one of its own
_FIELDS = ("n", "prefix_chars", "middle_chars")
_CUTS = pa.struct([(name, pa.int64()) for name in _FIELDS])


def _runs(offsets: np.ndarray) -> Iterator[slice]:
    """Runs of texts of about ``_TOGETHER`` bytes; a longer text is a run of its own."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + _TOGETHER, "right")) - 1
        last = max(last, first + 1)
        yield slice(first, last)
        first = last


def cuts(data: np.ndarray, offsets: np.ndarray, first: np.ndarray, second: np.ndarray, ends: Sequence[int]) -> list[np.ndarray]:
    """Units, characters before the first cut and between the cuts, for every text.

    ``data`` holds the texts' bytes, ``offsets`` where each starts and, last, where all
    end.  The cuts follow ``first`` and ``second`` modulo units + 1, the smaller before.
    """
    found = []
    for run in _runs(offsets):
        base = offsets[run.start]
        low, high = offsets[run] - base, offsets[run.start + 1 : run.stop + 1] - base
        matrix = WaveletMatrix(_CLASS[data[base : base + high[-1]]], _LEVELS)
        before, upto = matrix.ranks(ends, low), matrix.ranks(ends, high)
        open_ = (high > low) & (matrix.ranks(ends, np.maximum(high - 1, low)) == upto)
        n = upto - before + open_
        a, b = first[run] % (n + 1), second[run] % (n + 1)
        places = [low]
        for k in (np.minimum(a, b), np.maximum(a, b)):
            places.append(matrix.reach(ends, before + k, low, high))
        chars = [p - matrix.rank(CONTINUED, p) for p in places]
        found.append((n, chars[1] - chars[0], chars[2] - chars[1]))
    return [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, dtype=np.int64)] * 3


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8), at


def _draw(seed: int, doc_id: Column, group: int) -> Column:
    """The ``group``-th eight hexadecimal digits of the row's hash, as a number."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(key.cast("binary"), 256), 8 * group + 1, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame, unit: str = "line", rate: int = 100, spm: int = 50, seed: int = 7, name: str = "fim"
) -> DataFrame:
    """Add a struct of ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` to every row.

    Each text is cut at two unit boundaries drawn from a hash of ``doc_id``, and
    written as ``<P>prefix<S>suffix<M>middle`` (form ``psm``) or, for ``spm`` in a
    hundred, ``<S>suffix<P>prefix<M>middle`` (form ``spm``).  All but ``rate`` in a
    hundred, empty texts, and texts that hold a mark already, stay as they are (form
    ``plain``, no character counts); :func:`restored` gives every text back.

    Boundaries come from a wavelet matrix over classes of bytes, one for a few million
    bytes of texts: ranks of the classes that end a unit add up to boundary counts,
    bisection on them finds the cuts, and the rank of continuing bytes turns places
    into characters.  One pass, no shuffle; a task holds a batch of rows, and of its
    longest text about four times its bytes more.

    A NULL text counts as empty and a NULL ``doc_id`` hashes as nothing, so rows of
    the same id are cut alike.  Repeated rows stay; an empty table gives an empty
    result.  All columns stay as they are; if one has the name ``name``, the struct's
    gets underscores.
    """
    ends = UNITS[unit]

    @F.arrow_udf("n long, prefix_chars long, middle_chars long")
    def cut(texts: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
        data, offsets = _bytes_of(texts)
        found = cuts(data, offsets, first.to_numpy(False), second.to_numpy(False), ends)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in found], fields=list(_CUTS))

    made = unused("_cut", docs.columns)
    name = unused(name, docs.columns)
    text, doc_id = F.coalesce(F.col("text"), F.lit("")), F.col("doc_id")
    have = docs.select("*", cut(text, _draw(seed, doc_id, 0), _draw(seed, doc_id, 1)).alias(made))
    before, between = (F.col(made)[field] for field in _FIELDS[1:])
    prefix = F.substring(text, F.lit(1), before.cast("int"))
    middle = F.substring(text, (before + 1).cast("int"), between.cast("int"))
    suffix = F.substring(text, (before + between + 1).cast("int"), F.length(text))
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    plain = (text == "") | marked | (_draw(seed, doc_id, 2) % 100 >= rate)
    form = F.when(plain, "plain").when(_draw(seed, doc_id, 3) % 100 < spm, "spm").otherwise("psm")
    shaped = have.select("*", form.alias(made + "form"))
    form = F.col(made + "form")
    output = (
        F.when(form == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .when(form == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(text)
    )
    counts = [F.when(form != "plain", F.col(made)[field]).alias(field) for field in _FIELDS[1:]]
    row = F.struct(F.col(made)["n"].alias("n"), form.alias("form"), *counts, output.alias("output"))
    return shaped.select(*map(quoted, docs.columns), row.alias(name))


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was written from.  No text that is cut holds a mark, so the three
    marks are where the output splits."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), 4)
    prefix, suffix = (F.when(form == "psm", F.get(parts, F.lit(i))).otherwise(F.get(parts, F.lit(3 - i))) for i in (1, 2))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, F.get(parts, F.lit(3)), suffix))
