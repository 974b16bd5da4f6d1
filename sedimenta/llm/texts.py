"""Word shingles and byte hashes of whole texts, in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: Words per shingle.
SHINGLE_WORDS = 5

_U = np.uint64
_RANDOM = np.random.default_rng(20240229)
_BYTE_VALUES = _RANDOM.integers(0, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACES = _RANDOM.integers(0, 1 << 63, SHINGLE_WORDS + 1, dtype=_U) * _U(2) + _U(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class RollingHash:
    """Hashes of any stretches of one byte string, from its prefix sums."""

    _cache: dict[str, np.ndarray] = {"up": powers(_BASE, 1), "down": powers(_BASE_INVERSE, 1)}

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(self._cache["up"]) < n:
            self._cache["up"], self._cache["down"] = powers(_BASE, n), powers(_BASE_INVERSE, n)
        self._down = self._cache["down"]
        self._sums = np.zeros(n, dtype=_U)
        np.cumsum(_BYTE_VALUES[data] * self._cache["up"][: n - 1], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self._sums[end] - self._sums[start]) * self._down[start])

    def every(self, length: int) -> np.ndarray:
        """Of all stretches of ``length`` bytes, in order."""
        n = len(self._sums) - length
        if n <= 0:
            return np.empty(0, dtype=_U)
        return mixed((self._sums[length:] - self._sums[:n]) * self._down[:n])


def slices(texts: Sequence[bytes], most: int = 250_000) -> Iterator[range]:
    """Runs of texts of about ``most`` bytes; a longer text is a run of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield range(start, i)
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield range(start, len(texts))


def shingle_sets(texts: Sequence[bytes]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's five-word shingles.

    Words are runs of anything but ASCII white space.  A text of one to four words
    has one shingle, of all its words; one without words has none.
    """
    out: list[np.ndarray] = []
    for run in slices(texts):
        out += _shingles(texts[run.start : run.stop])
    return out


def _shingles(texts: Sequence[bytes]) -> list[np.ndarray]:
    data = np.frombuffer(b" " + b" ".join(texts) + b" ", dtype=np.uint8)
    bounds = np.concatenate([[1], 1 + np.cumsum([len(t) + 1 for t in texts])])
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return [np.empty(0, dtype=_U) for _ in texts]
    words = RollingHash(data).of(starts, ends)
    first = np.searchsorted(starts, bounds)  # of each text among the words
    k = SHINGLE_WORDS
    whole = np.zeros(max(0, len(words) - k + 1), dtype=_U)
    for i in range(k if len(whole) else 0):
        whole += words[i : i + len(whole)] * _PLACES[i]
    whole = mixed(whole)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= k:
            own = np.sort(whole[a : b - k + 1])
            keep = np.ones(len(own), dtype=bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        elif b > a:
            total = (words[a:b] * _PLACES[: b - a]).sum(dtype=_U, keepdims=True)
            out.append(mixed(total + _PLACES[k : k + 1] * np.array([b - a], dtype=_U)))
        else:
            out.append(np.empty(0, dtype=_U))
    return out
