"""Numpy helpers that run inside Spark tasks: words, hashes and packed arrays.

Every function works on one bounded block (an Arrow batch or a chunk of a few
megabytes); Spark decides which task gets which block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of the contract's word separator class [\x20\x09-\x0D]
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: A-Z to a-z, every other byte unchanged
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: every ASCII byte but letters and digits
NOT_ALNUM = np.zeros(256, dtype=bool)
NOT_ALNUM[:128] = [not chr(c).isalnum() for c in range(128)]
#: words hashed at once, so that the byte-wide temporaries stay small
BLOCK_WORDS = 150_000

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection), vectorised."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def multipliers(n: int, seed: int) -> np.ndarray:
    """n odd pseudo-random 64-bit multipliers; a prefix is the same for any n."""
    k = np.arange(1, n + 1, dtype=np.uint64) + _U(seed * 0x9E3779B97F4A7C15 % 2**64)
    return mix(k * _U(0xD1342543DE82EF95)) | _U(1)


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow string column (null counts as empty)."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.string())
    arr = pc.fill_null(arr, "").cast(pa.large_string())
    offs = np.frombuffer(arr.buffers()[1], np.int64, len(arr) + 1, arr.offset * 8) \
        if len(arr) else np.zeros(1, np.int64)
    if offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    data = np.frombuffer(arr.buffers()[2], np.uint8)[offs[0]:offs[-1]]
    return data, offs - offs[0]


def slices(column, size: int = 2 << 20):
    """(from, to) of runs of an Arrow string column's rows with about ``size``
    bytes of text each (or one long text)."""
    end = np.cumsum(pc.fill_null(pc.binary_length(column.cast(pa.string())), 0).to_numpy(zero_copy_only=False))
    a = 0
    while a < len(end):
        b = max(a + 1, int(np.searchsorted(end, (end[a - 1] if a else 0) + size, "right")))
        yield a, b
        a = b


class Words:
    """Word spans of a block of texts.

    start, end: byte span of each word; first: index of each text's first
    word (one more entry than texts); text: the text that holds each word.
    """

    def __init__(self, data: np.ndarray, offs: np.ndarray, lower: bool = False,
                 gap: np.ndarray = SPACE):
        self.data = LOWER[data] if lower else data
        self.offs = offs
        n = len(data)
        space = gap[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offs] = True
        word = ~space
        before = np.ones(n, dtype=bool)
        before[1:] = space[:-1]
        after = np.ones(n, dtype=bool)
        after[:-1] = space[1:]
        self.start = np.flatnonzero(word & (before | edge[:-1]))
        self.end = np.flatnonzero(word & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offs)
        self.count = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def hashes(self, seed: int) -> np.ndarray:
        """One 64-bit hash a word: a multilinear sum over its bytes, mixed."""
        out = np.empty(len(self.start), np.uint64)
        longest = int((self.end - self.start).max()) if len(self.start) else 0
        mult = multipliers(longest, seed)
        for i in range(0, len(self.start), BLOCK_WORDS):
            s, e = self.start[i:i + BLOCK_WORDS], self.end[i:i + BLOCK_WORDS]
            size = e - s
            at = np.concatenate(([0], np.cumsum(size)))
            place = np.arange(at[-1]) - np.repeat(at[:-1], size)
            byte = self.data[np.repeat(s, size) + place].astype(np.uint64)
            byte += _U(1)
            byte *= mult[place]
            out[i:i + BLOCK_WORDS] = mix(np.add.reduceat(byte, at[:-1]))
        return out

    def has_window(self, n: int) -> np.ndarray:
        """True at each word where n words of the same text begin."""
        left = np.repeat(self.first[1:], self.count) - np.arange(len(self.start))
        return left >= n

    def list(self, text: int) -> list[bytes]:
        a, b = int(self.offs[text]), int(self.offs[text + 1])
        return self.data[a:b].tobytes().split()


def windows(h: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hash of the n values that begin at each position; len(h) - n + 1 of them."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    mult = multipliers(n, seed)
    acc = h[:m] * mult[0]
    for j in range(1, n):
        acc += h[j:j + m] * mult[j]
    return mix(acc)


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of the w values that begin at each position."""
    size, cur = 1, v
    while size * 2 <= w:
        cur = np.minimum(cur[:len(cur) - size], cur[size:])
        size *= 2
    m = len(v) - w + 1
    return np.minimum(cur[:m], cur[w - size:w - size + m]) if m > 0 else v[:0]


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a 64-bit hash; grows with the hash, so sorted hashes stay sorted."""
    return ((h >> _U(32)) * _U(shards)) >> _U(32)


def pack(a: np.ndarray) -> bytes:
    """A fixed-width integer array as compressed byte planes."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes()
    return pa.compress(planes, codec="zstd", asbytes=True)


def unpack(b: bytes, n: int, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = pa.decompress(b, decompressed_size=n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T) \
        .view(dtype).reshape(-1)


def pack_sorted(a: np.ndarray) -> bytes:
    """As pack(), for ascending values: only the steps are stored."""
    return pack(np.diff(a, prepend=a.dtype.type(0)))


def unpack_sorted(b: bytes, n: int, dtype) -> np.ndarray:
    return np.cumsum(unpack(b, n, dtype), dtype=dtype)


def groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts by the keys (first key first, ties by position) and,
    in that order, True where a new group begins."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), dtype=bool)
    if len(order):
        new[0] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    return order, new
