"""Vectorised text kernels shared by the operators: word spans, word hashes, rolling window hashes.

All functions work on one flat ``uint8`` buffer holding several texts back to back plus an ``offsets`` array, which
is how Arrow hands over a string column, so nothing here loops over characters or words in Python.
Hashes depend on the bytes only; they are the same on every machine and in every run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes of text hashed at once; bounds the temporary arrays (about 30 bytes for each byte of text).
BLOCK = 1 << 20

# White space of the word contracts: space and 0x09-0x0D.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
IS_WORD = ~IS_SPACE

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_seed = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _seed.integers(0, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: spreads the entropy of every bit over all 64."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(10, (n - 1).bit_length())
            for name, b in (("up", self.base), ("down", self.inverse)):
                x = np.full(size, b, U64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))
        return self.up[:n], self.down[:n]


CHAR_POWERS = Powers(0x9E3779B97F4A7C15)
WORD_POWERS = Powers(0xD1342543DE82EF95)
WORD_POWERS_2 = Powers(0xAF251AF3B0F025B5)


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary column; nulls count as empty."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(a, pa.ChunkedArray):
        a = pa.concat_arrays(a.chunks) if a.num_chunks else pa.array([], pa.large_string())
    a = a.cast(pa.large_binary()) if not pa.types.is_large_binary(a.type) else a
    if a.null_count:
        a = pc.fill_null(a, b"")
    if not len(a):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = a.buffers()
    off = np.frombuffer(offs, np.int64)[a.offset : a.offset + len(a) + 1]
    data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def pieces(offsets: np.ndarray, limit: int = BLOCK):
    """Row ranges [a, b) whose texts have about ``limit`` bytes together (one row at least)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b
        a = b


def spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray = IS_WORD):
    """Maximal runs of member bytes inside each text: (starts, ends, first run of each text)."""
    w = member[data]
    before, after = np.zeros(len(w), bool), np.zeros(len(w), bool)
    before[1:], after[:-1] = w[:-1], w[1:]
    inner = offsets[(offsets > 0) & (offsets < len(w))]
    before[inner], after[inner - 1] = False, False
    starts, ends = np.flatnonzero(w & ~before), np.flatnonzero(w & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] for sorted, disjoint spans."""
    out, a, n = np.empty(len(starts), U64), 0, len(starts)
    while a < n:
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + BLOCK, "right")))
        lo, hi = int(starts[a]), int(ends[b - 1])
        up, down = CHAR_POWERS.get(hi - lo + 1)
        total = np.zeros(hi - lo + 1, U64)
        np.cumsum(_BYTE[data[lo:hi]] * up[: hi - lo], out=total[1:])
        s, e = starts[a:b] - lo, ends[a:b] - lo
        out[a:b] = mix((total[e] - total[s]) * down[s] + (e - s).astype(U64))
        a = b
    return out


def rolling(hashes: np.ndarray, first: np.ndarray, size: int, powers: Powers = WORD_POWERS):
    """Hashes of ``size`` consecutive words of one text, and the index of each window's first word.

    ``first[i]:first[i+1]`` are the words of text i; windows never cross texts."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    up, down = powers.get(n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum(hashes * up[:n], out=total[1:])
    value = mix((total[size:] - total[:-size]) * down[: n - size + 1])
    room = np.repeat(first[1:], np.diff(first))[: n - size + 1] - np.arange(n - size + 1)
    at = np.flatnonzero(room >= size)
    return value[at], at


def cover(at: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n places lie in [p, p + size) for some p in ``at``."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, at, 1) if len(at) < 64 else np.copyto(d, np.bincount(at, minlength=n + 1)[: n + 1].astype(np.int32))
    e = np.bincount(np.minimum(at + size, n), minlength=n + 1)[: n + 1].astype(np.int32) if len(at) else 0
    return np.cumsum(d - e)[:n] > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    d = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)
