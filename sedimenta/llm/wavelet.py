"""A wavelet matrix: counts of any symbol before any place, for many places at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_U = np.uint64


class Bits:
    """A bit string that counts its ones before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self._words = np.zeros(len(bits) // 64 + 1, dtype=_U)
        self._words.view(np.uint8)[: len(packed)] = packed
        self._before = np.zeros(len(self._words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self._words), out=self._before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (_U(1) << (at & 63).astype(_U)) - _U(1)
        return self._before[word] + np.bitwise_count(self._words[word] & below)


class WaveletMatrix:
    """Symbols of a few bits, as one :class:`Bits` per bit of a symbol.

    Each level takes one bit, the highest first, and then stably puts the symbols
    with a 0 there before those with a 1.  About one byte per symbol is kept.
    """

    def __init__(self, symbols: np.ndarray, levels: int):
        self.size = len(symbols)
        self._levels: list[tuple[int, Bits, int]] = []
        for bit in reversed(range(levels)):
            set_ = (symbols >> bit & 1).astype(bool)
            rest = symbols[~set_]
            self._levels.append((bit, Bits(set_), len(rest)))
            symbols = np.concatenate([rest, symbols[set_]])
        self._start = {}

    def _follow(self, symbol: int, at: np.ndarray) -> np.ndarray:
        for bit, bits, zeros in self._levels:
            ones = bits.ones(at)
            at = zeros + ones if symbol >> bit & 1 else at - ones
        return at

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` symbols are ``symbol``."""
        if symbol not in self._start:
            self._start[symbol] = self._follow(symbol, np.zeros(1, dtype=np.int64))[0]
        return self._follow(symbol, at) - self._start[symbol]

    def ranks(self, symbols: Sequence[int], at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` symbols are among ``symbols``."""
        return sum((self.rank(s, at) for s in symbols), np.zeros(len(at), dtype=np.int64))

    def reach(self, symbols: Sequence[int], wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The first place from ``low`` on that has ``wanted`` of ``symbols`` before it, ``high`` if none has."""
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            enough = self.ranks(symbols, middle) >= wanted
            high = np.where(open_ & enough, middle, high)
            low = np.where(open_ & ~enough, middle + 1, low)
        return low
