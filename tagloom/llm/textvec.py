"""Word boundaries and word hashes of whole Arrow batches of texts, as numpy arrays.

Words are maximal runs of bytes other than space and ``\\t``..``\\r``. Everything is computed over the
UTF-8 bytes of many documents at once; ``slices`` cuts a batch into pieces of bounded bytes, so the
temporary arrays stay small whatever the batch holds (a single text is never cut).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19  # texts are processed in pieces of about this many bytes

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20  # A-Z only

_BYTE = np.random.default_rng(20240611).integers(1, 2**63, 256, dtype=np.int64).view(np.uint64) * np.uint64(2) + np.uint64(1)
_K = np.uint64(0x9E3779B97F4A7C15)
_K_INV = np.uint64(pow(int(_K), -1, 2**64))
_STEP = np.uint64(0xD1342543DE82EF95)
_pow: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow.get("k", ())) < n:
        size = max(n, 2 * SLICE_BYTES)
        for name, base in (("k", _K), ("inv", _K_INV)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _pow[name] = np.multiply.accumulate(p)
    out = _pow["k"][:n], _pow["inv"][:n]
    if len(_pow["k"]) > 8 * SLICE_BYTES:
        _pow.clear()  # tables made for one very long text are not kept
    return out


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes: every input bit changes every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def flat(values: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts as one array, and offsets of each text in it; null counts as empty."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if values.null_count:
        values = values.fill_null("")
    values = values.cast(pa.large_binary())
    _, off, data = values.buffers()
    o = np.frombuffer(off, dtype=np.int64)[values.offset : values.offset + len(values) + 1] if off else np.zeros(1, np.int64)
    d = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return d[o[0] : o[-1]], o - o[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of texts of about ``limit`` bytes together; a longer text is a range of its own."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


@dataclass
class Words:
    data: np.ndarray  # bytes of the texts
    offsets: np.ndarray  # texts in data
    starts: np.ndarray  # words in data
    ends: np.ndarray
    bounds: np.ndarray  # text i has words bounds[i]:bounds[i + 1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        power, inverse = _powers(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[self.data] * power[:-1], out=total[1:])
        return mix((total[self.ends] - total[self.starts]) * inverse[self.starts])


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = IS_SPACE) -> Words:
    """Words of texts lying one after the other in ``data``; none reaches over the end of its text."""
    inside = ~separator[data]
    edge = np.ones(len(data) + 1, dtype=bool)  # a word cannot run on over this position
    edge[1:-1] = ~inside[:-1]
    edge[offsets] = True
    starts = np.flatnonzero(inside & edge[:-1])
    edge[:-1] = ~inside
    edge[offsets] = True
    edge[-1] = True
    ends = np.flatnonzero(inside & edge[1:]) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def windows(word_hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words, and their first word's place; no run reaches over a text's end."""
    total = len(word_hashes) - n + 1
    if total <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.full(total, n, dtype=np.uint64)
    for i in range(n):
        h *= _STEP
        h += word_hashes[i : i + total]
    last = np.repeat(bounds[1:], np.diff(bounds))[:total]  # end of the text that each word is in
    at = np.flatnonzero(np.arange(total) + n <= last)
    return mix(h[at]), at


def shingle_sets(w: Words, n: int, word_hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingles of each text as sorted hashes, and bounds of each text's set.

    A text of fewer than n words has its whole sequence as one shingle; one without words has none.
    """
    wh = w.hashes() if word_hashes is None else word_hashes
    h, at = windows(wh, w.bounds, n)
    cut = np.searchsorted(at, w.bounds)
    sets, size = [], np.zeros(len(w.bounds), dtype=np.int64)
    for i, k in enumerate(w.counts):
        if k >= n:
            s = np.sort(h[cut[i] : cut[i + 1]])
            s = s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif k:
            s = windows(wh[w.bounds[i] : w.bounds[i + 1]], np.array([0, k]), int(k))[0]
        else:
            continue
        sets.append(s)
        size[i + 1] = len(s)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.cumsum(size)
