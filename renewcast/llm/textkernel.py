"""Vectorised text primitives on Arrow string batches: byte views, word spans, rolling hashes, anchors.

Hashes are polynomial in an odd base modulo 2**64, computed by prefix sums and finalised by a bit mixer, so equal
content has equal hashes in every partition and on every machine.  Such polynomials confuse some sequences of
1,024 symbols and more (Thue-Morse); words of over ``LONG`` bytes therefore have cryptographic hashes, and spans
of items stay far below that length.
"""
from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64


def _return_memory(threshold: int = 4 << 20) -> None:
    """Have the C library give large arrays back at once (M_MMAP_THRESHOLD, M_TRIM_THRESHOLD), Arrow's too, so that
    a worker that is used again holds no more than its own task needs.  Other C libraries are left alone."""
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, threshold)
        libc.mallopt(-1, threshold)
    except (OSError, AttributeError):
        return
    pa.set_memory_pool(pa.system_memory_pool())


_return_memory()
#: Words end at these bytes (ASCII white space).
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BASE1, BASE2 = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F)
#: Texts are taken together up to about this many bytes, to bound the temporaries of one step.
STEP_BYTES = 1 << 20
LONG = 128


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Powers:
    """base**j and base**-j modulo 2**64, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, U(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = 1 << (n - 1).bit_length()
            for name, b in (("up", self.base), ("down", self.inverse)):
                p = np.full(size, b, U)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up[:n], self.down[:n]


_P1, _P2 = Powers(BASE1), Powers(BASE2)


def prefix_hash(values: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums (one longer than values) and the inverse powers that shift a difference back to 0."""
    up, down = powers.get(len(values) + 1)
    total = np.zeros(len(values) + 1, U)
    np.cumsum(values * up[:-1], out=total[1:])
    return total, down


def span_hash(total: np.ndarray, down: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((total[end] - total[start]) * down[start])


def texts(column: pa.Array, step: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows; null counts as empty.  Offsets start at 0.  A run has up to
    ``step`` bytes (``STEP_BYTES``) or is one row."""
    step = step or STEP_BYTES
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64, n + 1 + column.offset)[column.offset:]
    data = np.frombuffer(data, np.uint8) if data is not None and off[-1] else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(off, off[row] + step, "right")) - 1)
        end = min(end, n)
        yield row, data[off[row]:off[end]], off[row:end + 1] - off[row]
        row = end


def word_spans(data: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word; is_word tells by byte what belongs to one.  No word crosses a row."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = is_word[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:n]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total, down = prefix_hash(data.astype(U) + U(1), _P1)
    out = span_hash(total, down, start, end)
    for i in np.flatnonzero(end - start > LONG):
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i]:end[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def row_bounds(row: np.ndarray, rows: int) -> np.ndarray:
    """First item of each row, and the number of items at the end."""
    return np.searchsorted(row, np.arange(rows + 1))


def anchors(items: np.ndarray, row: np.ndarray, bound: np.ndarray, gram: int, window: int):
    """Segments of windows that choose the same anchor.

    items are hashes; row is the row of each; a window is ``window`` consecutive items of one row.  Each
    window chooses the leftmost of its grams (``gram`` items) with the smallest hash, so equal windows choose
    equal anchors.  Returns (anchor hash, first window, number of windows), a maximal run of windows that
    choose the same gram each, and the prefix sums from which other hashes can be had.
    """
    n = len(items)
    total, down = prefix_hash(items, _P1)
    z = np.zeros(0, np.int64)
    if n < window:
        return np.zeros(0, U), z, z, (total, down)
    at = np.arange(n - gram + 1)
    g = span_hash(total, down, at, at + gram)
    width, best, have = window - gram + 1, at, 1
    while have < width:
        step = min(have, width - have)
        a, b = best[:len(best) - step], best[step:]
        best = np.where(g[b] < g[a], b, a)
        have += step
    p = np.arange(len(best))
    good = p + window <= bound[row[:len(p)] + 1]
    p, best = p[good], best[good]
    if not len(p):
        return np.zeros(0, U), z, z, (total, down)
    new = np.ones(len(p), bool)
    new[1:] = (best[1:] != best[:-1]) | (p[1:] != p[:-1] + 1)
    first = np.flatnonzero(new)
    return g[best[first]], p[first], np.diff(np.append(first, len(p))), (total, down)


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ..., first[1], ...: count[i] numbers from each first[i]."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count)
    return np.arange(total) + shift


def cover(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of n places lie in any of the given ranges."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, start, 1)
    np.add.at(d, end, -1)
    return np.cumsum(d[:n]) > 0
