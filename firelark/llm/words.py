"""Words of many texts at once: spans and 64-bit hashes by numpy over the UTF-8 bytes of an Arrow column."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from firelark.llm.shared import mix64

CHUNK_BYTES = 1 << 20  # texts are handled in chunks of about so many bytes (one longer text is a chunk)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE, _STEP = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64 for i under n."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        size = max(n, 1 << 16)
        p = np.full(size, base, np.uint64)
        q = np.full(size, pow(base, -1, 1 << 64), np.uint64)
        p[0] = q[0] = 1
        _POWERS[base] = (np.multiply.accumulate(p), np.multiply.accumulate(q))
    p, q = _POWERS[base]
    return p[:n], q[:n]


@dataclass
class Words:
    """hashes, start and end bytes of all words of a chunk; of[i]:of[i + 1] are those of text i."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    of: np.ndarray

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on (the last k - 1 of the chunk have none); mask by text yourself."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        p, q = _powers(_STEP, len(self.hashes) + 1)
        total = np.zeros(len(self.hashes) + 1, np.uint64)
        np.cumsum(self.hashes * p[:-1], out=total[1:])
        return mix64((total[k:] - total[:n]) * q[:n] + np.uint64(k))


def hash_words(data: np.ndarray, offsets: np.ndarray, lower: bool) -> Words:
    """data: bytes of a chunk; offsets: where its texts start, and the end."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), z, z, np.zeros(len(offsets), np.int64))
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    p, q = _powers(_BASE, n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(((_LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1)) * p, out=total[1:])
    return Words(mix64((total[ends] - total[starts]) * q[starts]), starts, ends, np.searchsorted(starts, offsets))


def chunks(col: pa.Array, lower: bool = False):
    """(first row, Words) over a string column in chunks; null is empty."""
    col = col.fill_null("").cast(pa.large_string())
    if len(col) == 0:
        return
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], np.int64, len(col) + 1 + col.offset)[col.offset :]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + CHUNK_BYTES, "right")) - 1)
        yield i, hash_words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], lower)
        i = j
