"""Canonical prefix codes of limited length: lengths from counts, whole arrays at a time."""

from __future__ import annotations

import numpy as np

_U = np.uint64


def code_lengths(counts: np.ndarray, longest: int) -> np.ndarray:
    """Bits of each symbol's code so that the total is least and none is over ``longest``.

    Symbols that do not occur get no code (0); a single one gets one bit.  Package-merge:
    ``longest`` times, sorted symbols are merged with pairs of the round before; going
    back, each round's first items say which symbols take one more bit.
    """
    lengths = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} symbols need codes of more than {longest} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64)  # sums of pairs may pass 64 bits
    single, pairs = [], np.empty(0)
    for _ in range(longest):
        items = np.concatenate([weights, pairs])
        order = np.argsort(items, kind="stable")
        single.append(order < len(weights))
        items = items[order]
        pairs = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take = 2 * (len(used) - 1)
    for own in reversed(single):
        symbols = int(own[:take].sum())
        lengths[used[:symbols]] += 1
        take = 2 * (take - symbols)
    return lengths


class PrefixCode:
    """The canonical code of given lengths: shorter codes first, then by symbol."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        self.longest = int(lengths.max(initial=1))
        sizes = np.left_shift(1, self.longest - self.lengths[order])
        starts = np.cumsum(sizes) - sizes
        self.codes = np.zeros(len(lengths), dtype=_U)
        self.codes[order] = starts >> (self.longest - self.lengths[order])
        # What the next ``longest`` bits stand for.
        self._symbol = np.zeros(1 << self.longest, dtype=np.uint32)
        self._length = np.ones(1 << self.longest, dtype=np.uint8)
        filled = int(sizes.sum())
        self._symbol[:filled] = np.repeat(order, sizes)
        self._length[:filled] = np.repeat(self.lengths[order], sizes)

    def encode(self, ids: np.ndarray, every: int) -> tuple[bytes, np.ndarray]:
        """The ids' codes as bytes, and the bit at which every ``every``-th id starts."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        starts = ends - lengths
        total = int(ends[-1]) if len(ids) else 0
        words = np.zeros((total >> 6) + 2, dtype=_U)
        if len(ids):
            codes, word, over = self.codes[ids], starts >> 6, (starts & 63) + lengths - 64
            own = np.where(over > 0, codes >> np.maximum(over, 0).astype(_U), codes << np.maximum(-over, 0).astype(_U))
            first = np.flatnonzero(np.diff(word, prepend=-1))
            words[word[first]] = np.bitwise_or.reduceat(own, first)
            # Only the last code that starts in a word can run into the next one.
            split = np.flatnonzero(over > 0)
            words[word[split] + 1] |= codes[split] << (64 - over[split]).astype(_U)
        return words.astype(">u8").tobytes()[: (total + 7) // 8], starts[::every]

    def decode(self, data: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of several stretches of codes, one after another: ``counts`` ids from each bit of
        ``starts``.  All stretches advance together, one table look-up an id."""
        padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
        four = padded[:-3].astype(np.uint32)
        for i in range(1, 4):
            four = four << np.uint32(8) | padded[i : len(padded) - 3 + i]
        at, most = starts.astype(np.int64), 8 * (len(four) - 1)
        steps = int(counts.max(initial=0))
        out = np.empty((steps, len(starts)), dtype=np.uint32)
        mask, shift = np.uint32((1 << self.longest) - 1), 32 - self.longest
        for step in range(steps):
            window = four[at >> 3] >> (shift - (at & 7)).astype(np.uint32) & mask
            out[step] = self._symbol[window]
            at = np.minimum(at + self._length[window], most)
        return out.T[np.arange(steps) < counts[:, None]]
