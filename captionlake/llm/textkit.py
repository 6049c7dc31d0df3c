"""Vectorised words, word hashes and n-gram hashes over the UTF-8 bytes of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at a time: small enough for caches, and for the memory of a worker.
BLOCK = 1 << 20
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_VALUE = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
LOWER_BYTES = _LOWER.tobytes()

#: Bytes of words: all but ASCII white space, or digits, a-z (after lower-casing) and all beyond ASCII.
SPACED = np.ones(256, bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[65:91] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(33))) * _M1
    h = (h ^ (h >> np.uint64(33))) * _M2
    return h ^ (h >> np.uint64(33))


class _Powers:
    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", _P), ("down", _P_INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_powers = _Powers()


class Words:
    """Words of a run of texts: ``starts``/``ends`` as byte offsets in ``data``, ``hashes`` of their bytes, ``texts`` the text of each word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, fold: bool = True):
        """``offsets``: len(texts) + 1 ascending byte offsets in ``data``; ``fold``: hash A-Z like a-z."""
        n = len(data)
        word = inside[data]
        edge = np.empty(n + 1, bool)
        edge[0], edge[n] = (word[0], word[-1]) if n else (False, False)
        np.not_equal(word[1:], word[:-1], out=edge[1:n])
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < n)]
        joined = np.unique(cuts[word[cuts] & word[cuts - 1]])  # a word ends and the next begins where one text ends
        bounds = np.flatnonzero(edge)
        if len(joined):
            bounds = np.sort(np.concatenate([bounds, joined, joined]))
        self.data, self.starts, self.ends = data, bounds[0::2], bounds[1::2]
        self.first = np.searchsorted(self.starts, offsets[:-1])  # of each text
        self.counts = np.diff(np.append(self.first, np.searchsorted(self.starts, offsets[-1])))
        self.texts = np.repeat(np.arange(len(self.counts)), self.counts)
        self._hash(_VALUE[_LOWER] if fold else _VALUE)

    def _hash(self, values: np.ndarray) -> None:
        """Polynomial hashes of the words' bytes, block by block."""
        out = np.zeros(len(self.starts), np.uint64)
        a = 0
        while a < len(self.starts):
            b = max(int(np.searchsorted(self.ends, self.starts[a] + BLOCK)), a + 1)
            lo, hi = int(self.starts[a]), int(self.ends[b - 1])
            up, down = _powers(hi - lo + 1)
            total = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(values[self.data[lo:hi]] * up[: hi - lo], out=total[1:])
            s, e = self.starts[a:b] - lo, self.ends[a:b] - lo
            out[a:b] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
            a = b
        self.hashes = out

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of k words in a row and whether the k words are of one text, for each first word that has k - 1 words after it."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        up, _ = _powers(k + 1)
        total = self.hashes[:n].copy()
        for j in range(1, k):
            total += self.hashes[j : j + n] * up[j]
        return mix(total), self.texts[:n] == self.texts[k - 1 :]


def blocks_of(column: pa.Array, limit: int = 2 * BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``limit`` bytes: first row, row after the last, their bytes, and byte offsets. Null texts are empty."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    _, raw_offsets, raw = column.buffers()
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(raw_offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = min(max(int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1, a + 1), n)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b
