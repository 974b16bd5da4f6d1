"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

# The base kinds, in order, with their patterns and least lengths.
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_mixed", "entropy_lower", "entropy_upper")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_ASSIGN_VALUE, _ACCESS_LENGTH, _HEX_LENGTH = 6, 20, 24

#: Characters per window.
WINDOW = 20
#: Per class: what a candidate string is made of, the least entropy of a window in
#: bits, and the kinds of characters a window must hold, one of each at least.
_LOWER, _UPPER, _DIGIT = (frozenset(s) for s in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"))
CLASSES = (
    ("entropy_hex", re.compile(r"(?<![A-Za-z0-9])[0-9A-Fa-f]{20,}(?![A-Za-z0-9])"), 3.0, (_DIGIT, _LOWER | _UPPER)),
    ("entropy_mixed", re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 3.6, (_DIGIT, _LOWER, _UPPER)),
    ("entropy_lower", re.compile(r"[a-z0-9]{20,}"), 3.5, (_DIGIT, _LOWER)),
    ("entropy_upper", re.compile(r"[A-Z0-9]{20,}"), 3.4, (_DIGIT, _UPPER)),
)
#: Shortest run of neighbouring letters or digits that counts as an alphabet or counting string.
_COUNTING = 8


def _counting(signs: str) -> str:
    """A pattern for runs of neighbours in ``signs``."""
    runs = []
    for i in range(len(signs) - _COUNTING + 1):
        more = "".join(f"(?:{c}" for c in signs[i + _COUNTING :]) + ")?" * (len(signs) - i - _COUNTING)
        runs.append(signs[i : i + _COUNTING] + more)
    return "|".join(runs)


#: What in a candidate is no part of a secret: placeholders, alphabets and counting
#: strings, and numbered identifiers.
ALLOWED = re.compile(
    "example|sample|placeholder|changeme|dummy|x{4,}|0{8,}"
    f"|{_counting('abcdefghijklmnopqrstuvwxyz')}|{_counting('ABCDEFGHIJKLMNOPQRSTUVWXYZ')}|{_counting('01234567890')}"
    "|(?<![A-Za-z0-9])[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}(?![A-Za-z0-9])"
)
#: An address: user info (not exempt), host and path; a query or fragment may follow.
_ADDRESS = re.compile(r"""(?:https?:/*|www\.)(?P<user>[^\s"'<>/?\#@]*(?:@[^\s"'<>/?\#@]*)*@)?[^\s"'<>?\#]*""")
#: What stands beside a span without being part of a secret.
_WORD = r"(?:[A-Z]?[a-z]+|[A-Z]+)"
_WORDS = re.compile(rf"{_WORD}?(?:[+/_=-]+{_WORD})*[+/_=-]*")

_TERMS = [0.0] + [n * log2(n) for n in range(1, WINDOW + 1)]


def entropy_spans(candidate: str, least: float, needed: tuple[frozenset, ...]) -> list[tuple[int, int]]:
    """Spans of the candidate covered by windows of at least ``least`` bits that
    hold a character of each needed kind.

    A step changes the counts of two characters, so the sum of ``n log n`` over
    the counts is updated, never recomputed.
    """
    counts: dict[str, int] = {}
    held = [0] * len(needed)
    total, spans = 0.0, []
    for at, new in enumerate(candidate):
        if at >= WINDOW:
            old = candidate[at - WINDOW]
            n = counts[old]
            counts[old] = n - 1
            total += _TERMS[n - 1] - _TERMS[n]
            for i, kind in enumerate(needed):
                held[i] -= old in kind
        n = counts.get(new, 0)
        counts[new] = n + 1
        total += _TERMS[n + 1] - _TERMS[n]
        for i, kind in enumerate(needed):
            held[i] += new in kind
        if at >= WINDOW - 1 and min(held) > 0 and log2(WINDOW) - total / WINDOW >= least:
            start, end = at - WINDOW + 1, at + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], end)
            else:
                spans.append((start, end))
    return spans


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= _ASSIGN_VALUE]
    found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= _ACCESS_LENGTH]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text) if len(m[0]) >= _HEX_LENGTH]
    return found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The stretches that ``spans`` cover, disjoint and in order."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def uncovered(start: int, end: int, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The stretches of ``start`` to ``end`` outside ``taken`` (disjoint and in order)."""
    out = []
    first = max(0, bisect_left(taken, (start,)) - 1)
    for a, b in taken[first : bisect_right(taken, (end,))]:
        if b <= start:
            continue
        if a > start:
            out.append((start, min(a, end)))
        start = b
    if start < end:
        out.append((start, end))
    return out


def addresses(text: str) -> list[tuple[int, int]]:
    """Host and path of each address in ``text``, in order."""
    out = []
    for m in _ADDRESS.finditer(text):
        if m["user"]:
            out += [(m.start(), m.start("user")), (m.end("user"), m.end())]
        else:
            out.append(m.span())
    return out


def judged_spans(text: str, start: int, end: int, least: float, needed: tuple[frozenset, ...]) -> list[tuple[int, int]]:
    """Entropy spans of ``text`` from ``start`` to ``end``, as if what the allow list
    matches there weren't in it."""
    allowed = [m.span() for m in ALLOWED.finditer(text, start, end)]
    if not allowed:
        return [(start + s, start + e) for s, e in entropy_spans(text[start:end], least, needed)]
    places = [i for a, b in uncovered(start, end, allowed) for i in range(a, b)]
    found = entropy_spans("".join([text[i] for i in places]), least, needed)
    return [(places[s], places[e - 1] + 1) for s, e in found]


def secret_spans(text: str | None) -> list[tuple[int, int, str]]:
    """All spans ``(start, end, kind)`` in code points, by start, then kind as listed.

    Base spans always stay; of an entropy span, the stretches outside them and outside
    earlier ones are added, unless they are words.  Host and path of addresses and
    what the allow list matches are no part of a candidate; all else of it is.
    """
    text = text or ""
    found = base_spans(text)
    taken = merged([(s, e) for s, e, _ in found])
    exempt = addresses(text)
    for kind, candidates, least, needed in CLASSES:
        for m in candidates.finditer(text):
            for start, end in uncovered(*m.span(), exempt):
                for whole in judged_spans(text, start, end, least, needed):
                    for s, e in uncovered(*whole, taken):
                        if (s, e) == whole or not _WORDS.fullmatch(text, s, e):
                            found.append((s, e, kind))
                            insort(taken, (s, e))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


_SPANS = ArrayType(
    StructType(
        [StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("kind", StringType())]
    )
)


_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))


# Texts become strings one at a time, so a task holds little besides its batch.
@F.arrow_udf(_SPANS)
def _scan(texts: pa.Array) -> pa.Array:
    found = [[{"start": s, "end": e, "kind": k} for s, e, k in secret_spans(t.as_py())] for t in texts]
    return pa.array(found, _ARROW_SPANS)


@F.arrow_udf(StringType())
def _redact(texts: pa.Array) -> pa.Array:
    return pa.array([redacted(t.as_py()) for t in texts], pa.string())


def redacted(text: str | None) -> str | None:
    """The text with each stretch covered by spans replaced by a mark."""
    if not text:
        return text
    out, at = [], 0
    for s, e, _ in secret_spans(text):
        if e <= at:
            continue
        if s >= at and (s > at or not out):
            out += [text[at:s], "[SECRET]"]
        at = e
    return "".join([*out, text[at:]])


def with_secret_spans(docs: DataFrame, name: str = "secrets") -> DataFrame:
    """``docs`` with the spans of its ``text`` as an array of (start, end, kind).

    One pass, no shuffle; a NULL or empty text has none.  All other columns, and
    repeated rows, stay as they are; a column that has the name ``name`` already is replaced.
    """
    return docs.withColumn(name, _scan("text"))


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets of its ``text`` replaced; NULL texts stay NULL."""
    return docs.withColumn("text", _redact("text"))


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
