"""Whole texts as flat byte arrays: word spans and 64-bit hashes with numpy.

Arrow hands a batch of texts over as one UTF-8 buffer with offsets. The functions here
work on that buffer directly (no Python object per word), in chunks of whole texts, so
a task's memory is a small multiple of ``CHUNK_BYTES`` or of its longest text.

Hashes are prefix sums of table[byte] * BASE**position modulo 2**64; the hash of a span
is the difference of two prefix sums, moved to position 0 by the inverse power and mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: ``[\x20\x09-\x0D]``: what separates words in most contracts.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True

_powers = {_BASE: np.ones(1, np.uint64), _BASE_INV: np.ones(1, np.uint64)}


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        steps = np.full(max(n, 2 * CHUNK_BYTES), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps)
    return _powers[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x = x * _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


@dataclass
class Chunk:
    """Texts ``first .. first+len(lengths)`` of a batch: their bytes and offsets (one more than texts)."""

    first: int
    buf: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Whole texts in chunks of about ``size`` bytes; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield Chunk(lo, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        lo = hi


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Prefix sums for ``span_hash`` (one more than bytes)."""
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_TABLE[buf] * _power(_BASE, len(buf)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((prefix[end] - prefix[start]) * _power(_BASE_INV, len(prefix))[start])


def word_spans(c: Chunk, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text index (in the chunk) of every word; words never cross texts."""
    word = ~separator[c.buf]
    before = np.empty_like(word)
    after = np.empty_like(word)
    if len(word):
        before[1:], before[0] = word[:-1], False
        after[:-1], after[-1] = word[1:], False
        edge = c.offsets[1:-1]
        before[edge[edge < len(word)]] = False
        after[edge[edge > 0] - 1] = False
    start = np.flatnonzero(word & ~before)
    end = np.flatnonzero(word & ~after) + 1
    return start, end, np.searchsorted(c.offsets, start, side="right") - 1


def word_hashes(c: Chunk, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text index, start and end of every word, A-Z lower-cased if asked."""
    start, end, text = word_spans(c)
    return span_hash(prefix_hash(LOWER[c.buf] if lower else c.buf), start, end), text, start, end


def window_hash(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive entries (entry i covers i .. i+width-1)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * _U(0x2545F4914F6CDD1D) + h[k:n + k]
    return mix(out)
