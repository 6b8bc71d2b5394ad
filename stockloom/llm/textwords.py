"""Words of many texts at once as 64-bit hashes, in numpy.

A word's hash is a polynomial over random byte values modulo 2^64, taken from running sums,
so no Python object is made per word. Blocks are cut at separators: a text of any length
needs the memory of one block plus one number per word.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240611))
BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = int(_rng.integers(1, 1 << 62)) * 8 + 5
BASE_INVERSE = pow(BASE, -1, 1 << 64)
MIX = np.uint64(0x9E3779B97F4A7C15)

#: ASCII letters A-Z as a-z, all else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Space and the five control characters from tab to carriage return.
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2^64."""
    out = np.ones(max(n, 1), np.uint64)
    if n > 1:
        out[1:] = np.uint64(base & ((1 << 64) - 1))
        np.multiply.accumulate(out, out=out)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * MIX
    return x ^ (x >> np.uint64(32))


class WordHasher:
    def __init__(self, separator: np.ndarray = BLANK, fold: np.ndarray = LOWER):
        self.separator, self.fold = separator, fold
        self.up, self.down = powers(BASE, BLOCK), powers(BASE_INVERSE, BLOCK)

    def _grow(self, n: int) -> None:
        if n > len(self.up):
            self.up, self.down = powers(BASE, n), powers(BASE_INVERSE, n)

    def __call__(self, data: np.ndarray, bounds: np.ndarray):
        """Hashes, byte starts and byte ends of the words, and each text's first word.

        The last array has one entry more than there are texts.
        """
        hashes, starts, ends = [], [], []
        at, total = 0, len(data)
        while at < total:
            stop = min(at + BLOCK, total)
            if stop < total:  # cut behind the last separator or at a text's start
                blank = np.flatnonzero(self.separator[data[at:stop]])
                edge = int(np.searchsorted(bounds, stop, "right")) - 1
                cut = max(at + int(blank[-1]) + 1 if len(blank) else at, int(bounds[edge]))
                if cut <= at:  # one word longer than a block
                    rest, cut = at + BLOCK, total
                    while rest < total:
                        more = np.flatnonzero(self.separator[data[rest : rest + BLOCK]])
                        if len(more):
                            cut = rest + int(more[0])
                            break
                        rest += BLOCK
                    cut = min(cut, int(bounds[min(edge + 1, len(bounds) - 1)]))
                stop = cut
            h, s, e = self._block(data[at:stop], bounds, at)
            hashes.append(h)
            starts.append(s)
            ends.append(e)
            at = stop
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        s = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        e = np.concatenate(ends) if ends else np.zeros(0, np.int64)
        return h, s, e, np.searchsorted(s, bounds)

    def _block(self, raw: np.ndarray, bounds: np.ndarray, at: int):
        n = len(raw)
        self._grow(n)
        inside = ~self.separator[raw]
        opens = np.zeros(n + 1, bool)  # a text starts here
        lo, hi = np.searchsorted(bounds, [at, at + n])
        opens[bounds[lo:hi] - at] = True
        first = inside.copy()
        first[1:] &= ~inside[:-1] | opens[1:n]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | opens[1:n]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        if not len(starts):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUE[self.fold[raw]] * self.up[:n], out=sums[1:])
        words = (sums[ends] - sums[starts]) * self.down[starts]
        return mix(words), starts + at, ends + at


def windows(hashes: np.ndarray, first: np.ndarray, width: int):
    """Hash of every run of ``width`` words inside one text.

    Returns the hashes, the position of each run's first word, and each text's first run
    (one entry more than texts). Texts with fewer words have none.
    """
    counts = np.diff(first)
    runs = np.maximum(counts - width + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(runs)])
    position = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - first[:-1], runs)
    out = np.zeros(len(position), np.uint64)
    factor = powers(int(MIX) | 1, width + 1)
    for k in range(width):
        out += hashes[position + k] * factor[k + 1]
    return mix(out), position, offsets
