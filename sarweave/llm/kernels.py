"""NumPy kernels over Arrow text columns: tokens, hashes, sliding minima.

Texts of one Arrow batch are taken as one byte array with offsets, without Python objects per
row or word. All hashes are 64 bits and the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240917))
#: A random 64-bit value for each byte, and two odd bases with their inverses modulo 2**64.
TABLE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
TABLE_LOWER = TABLE[_LOWER]
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: True for bytes of words: all but space and \x09-\x0D.
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[32, 9, 10, 11, 12, 13]] = False
#: Bytes of text that a kernel takes at once (single longer texts are taken whole).
CHUNK_BYTES = 1 << 19

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    got = _powers.get(base)
    if got is None or len(got) < n:
        size = max(n, 1 << 16, 0 if got is None else 2 * len(got))
        got = np.full(size, base & (2**64 - 1), dtype=np.uint64)
        got[0] = 1
        _powers[base] = got = np.cumprod(got, dtype=np.uint64)
    return got[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class RangeHash:
    """Hashes of any ranges of an array of 64-bit values, through prefix sums of v[i] * base**i."""

    def __init__(self, values: np.ndarray, lane: int = 0):
        self.base = BASES[lane]
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * powers(self.base, len(values)), out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        inv = powers(inverse(self.base), len(self.sums))
        h = (self.sums[end] - self.sums[start]) * inv[start]
        return mix(h + (end - start).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array and its n + 1 offsets; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null(b"" if pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type) else "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, off, data = arr.buffers()
    n = len(arr)
    if off is None or not n:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32, n + 1, arr.offset * (8 if wide else 4)).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most limit bytes each, of one row at least."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the index of its first word (n + 1 values)."""
    n = len(data)
    if not n:
        z = np.empty(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    w = IS_WORD[data]
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = w[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before[inner] = False
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = w[1:]
    after[inner - 1] = False
    starts = np.flatnonzero(w & ~before)
    ends = np.flatnonzero(w & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hashes of words; long texts are taken in pieces that end between words, for memory."""
    table = TABLE_LOWER if lower else TABLE
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + 2 * CHUNK_BYTES, side="right")))
        lo, hi = starts[i], ends[j - 1]
        out[i:j] = RangeHash(table[data[lo:hi]]).of(starts[i:j] - lo, ends[i:j] - lo)
        i = j
    return out


def gram_hashes(values: np.ndarray, k: int, lane: int = 0) -> np.ndarray:
    """Hashes of all runs of k values."""
    n = len(values) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    at = np.arange(n)
    return RangeHash(values, lane).of(at, at + k)


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbouring values, in a constant number of passes."""
    n = len(a) - w + 1
    if n <= 0:
        return a[:0]
    if w == 1:
        return a.copy()
    padded = np.full(-(-len(a) // w) * w, np.iinfo(a.dtype).max, dtype=a.dtype)
    padded[: len(a)] = a
    blocks = padded.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1 : w - 1 + n])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    d = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)
