"""A count-min sketch whose blocks are merged by Spark.

A sketch has ``DEPTH`` rows of ``blocks * 2**16`` cells.  Each task counts the keys it has seen, sends its
non-empty cells by block (two bytes a key and row), and the blocks are added up in parallel.  What is kept
of the sum is one bit a cell: whether the count reaches two.  The estimate never falls below the true
count, so no repeated key is missed; keys estimated repeated by mistake cost only work later.  The bits are
broadcast; their size is ``DEPTH * blocks * 8 KiB`` and blocks never exceed ``MAX_BLOCKS`` (128 MiB).

Beyond some 500 million keys such a sketch is full and takes most keys for repeated.  ``several`` has the same size and
isn't filled by keys that occur once: tasks send the keys' marks (32 bits and their block) instead of cells, equal marks
are found in each block, and only theirs are kept as bits.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from renewcast.llm.shared import discard, materialise, scratch
from renewcast.llm.textkernel import U, mix

DEPTH, MAX_BLOCKS = 2, 1 << 13
_FLUSH, _STEP = 1 << 22, 1 << 16


def blocks_for(keys: int, cells_per_key: float = 6.0) -> int:
    want = max(1, int(keys * cells_per_key) >> 16)
    return min(MAX_BLOCKS, 1 << (want - 1).bit_length())


def cells(keys: np.ndarray, blocks: int, depth: int) -> np.ndarray:
    bits = U(48 - (blocks.bit_length() - 1))
    return ((mix(keys + U(depth * 0x632BE59BD9B4E019 & (1 << 64) - 1)) >> bits)).astype(np.int64)


def _send(keys: np.ndarray, blocks: int) -> Iterator[pa.RecordBatch]:
    for depth in range(DEPTH):
        # In place and four bytes a key: two workers of an executor hold this at once, beside a grown JVM.
        cell = np.empty(len(keys), np.uint32)
        for i in range(0, len(keys), _STEP):
            cell[i:i + _STEP] = cells(keys[i:i + _STEP], blocks, depth)
        cell.sort()
        # Twice at most.
        cell = cell[np.append(np.ones(min(2, len(cell)), bool), cell[2:] != cell[:-2])]
        block = cell >> np.uint32(16)
        first = np.append(0, np.flatnonzero(block[1:] != block[:-1]) + 1)
        ids = block[first].astype(np.int32) + np.int32(depth * blocks)
        del block
        edge = pa.py_buffer((np.append(first, len(cell)) * 2).astype(np.int32))
        yield pa.record_batch([pa.array(ids), pa.BinaryArray.from_buffers(pa.binary(), len(ids), [None, edge, pa.py_buffer(cell.astype(np.uint16))])], names=["block", "cells"])


def build(df: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], blocks: int, least: int = 2, more: tuple[int, ...] = ()) -> np.ndarray:
    """Bits of the merged sketch (counts of at least ``least``, 1 or 2), shape (DEPTH, blocks * 8192).  keys_of: a batch's keys as 64-bit arrays.

    more: further counts, for each of which bits follow, with one more dimension in front.  As a task sends a key
    twice at most, these are rough and only good for ordering keys."""

    def partial(batches):
        held, n = [], 0
        for batch in batches:
            for keys in keys_of(batch):
                held.append(keys)
                n += len(keys)
                if n >= _FLUSH:
                    held, n = [np.concatenate(held)], 0
                    yield from _send(held.pop(), blocks)
        if n:
            yield from _send(np.concatenate(held), blocks)

    def merge(table: pa.Table) -> pa.Table:
        # Many parts have fewer cells than a block: they are counted together.
        found, count = np.frombuffer(b"".join(table["cells"].to_pylist()), np.uint16), np.zeros(1 << 16, np.int64)
        for i in range(0, len(found), _FLUSH):
            count += np.bincount(found[i:i + _FLUSH], minlength=1 << 16)
        return pa.table({"block": pa.array([table["block"][0].as_py()], pa.int32()), "bits": pa.array([b"".join(np.packbits(count >= n, bitorder="little").tobytes() for n in (least, *more))], pa.binary())})

    rows = df.mapInArrow(partial, "block int, cells binary").groupBy("block").applyInArrow(merge, "block int, bits binary")
    out = _filled(rows, blocks, 1 + len(more))
    return out if more else out[0]


def _filled(rows: DataFrame, blocks: int, kinds: int) -> np.ndarray:
    """Of rows (block, bits): the bits, by kind, depth and block."""
    # Written, so that the cells' shuffle is dropped and the driver asks for a few files instead of every partition.
    path = scratch(rows.sparkSession, "sketch")
    rows = materialise(rows, "sketch", path)
    out = np.zeros((kinds, DEPTH, blocks * 8192), np.uint8)
    for r in rows.toLocalIterator():
        depth, block = divmod(r["block"], blocks)
        out[:, depth, block * 8192:(block + 1) * 8192] = np.frombuffer(r["bits"], np.uint8).reshape(kinds, 8192)
    discard(rows.sparkSession, path)
    return out


def repeated(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys are estimated to occur at least twice."""
    blocks = bits.shape[1] // 8192
    found = np.ones(len(keys), bool)
    for depth in range(DEPTH):
        c = cells(keys, blocks, depth)
        found &= (bits[depth, c >> 3] >> (c & 7).astype(np.uint8)) & 1 == 1
    return found


def _marks(keys: np.ndarray, blocks: int) -> np.ndarray:
    """A key's block, and 32 bits of it below."""
    return mix(keys) >> U(32 - (blocks.bit_length() - 1))


def _send_marks(keys: np.ndarray, blocks: int) -> pa.RecordBatch:
    """Marks by block; the keys are overwritten."""
    for i in range(0, len(keys), _STEP):
        keys[i:i + _STEP] = _marks(keys[i:i + _STEP], blocks)
    keys.sort()
    # Twice at most.
    keys = keys[np.append(np.ones(min(2, len(keys)), bool), keys[2:] != keys[:-2])]
    edge = np.append(np.searchsorted(keys, np.arange(blocks, dtype=U) << U(32)), len(keys))
    ids = np.flatnonzero(np.diff(edge)).astype(np.int32)
    low = keys.astype(np.uint32)
    return pa.record_batch([pa.array(ids), pa.BinaryArray.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer((np.append(edge[ids], len(keys)) * 4).astype(np.int32)), pa.py_buffer(low)])], names=["block", "marks"])


def several(df: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], blocks: int) -> np.ndarray:
    """Bits, shape (DEPTH, blocks * 8192), of the keys that occur at least twice, for ``among``.  keys_of: as for build.
    Only these keys fill them, however many others there are."""

    def partial(batches):
        held, n = [], 0
        for batch in batches:
            for keys in keys_of(batch):
                held.append(keys)
                n += len(keys)
                if n >= _FLUSH:
                    held, n = [np.concatenate(held)], 0
                    yield _send_marks(held.pop(), blocks)
        if n:
            held = [np.concatenate(held)]
            yield _send_marks(held.pop(), blocks)

    def merge(table: pa.Table) -> pa.Table:
        found = np.frombuffer(b"".join(table["marks"].to_pylist()), np.uint32).copy()
        found.sort()
        found = found[1:][found[1:] == found[:-1]]
        block, bits = table["block"][0].as_py(), []
        for cell in (found >> np.uint32(16), found & np.uint32(0xFFFF)):
            of = np.zeros(1 << 16, bool)
            of[cell] = True
            bits.append(np.packbits(of, bitorder="little").tobytes())
        return pa.table({"block": pa.array([block + depth * blocks for depth in range(DEPTH)], pa.int32()), "bits": pa.array(bits, pa.binary())})

    rows = df.mapInArrow(partial, "block int, marks binary").groupBy("block").applyInArrow(merge, "block int, bits binary")
    return _filled(rows, blocks, 1)[0]


def among(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys are among those that ``several`` has found, or have their bits by chance."""
    mark = _marks(keys, bits.shape[1] // 8192)
    block = (mark >> U(32) << U(16)).astype(np.int64)
    found = np.ones(len(keys), bool)
    for depth, cell in enumerate((mark >> U(16) & U(0xFFFF), mark & U(0xFFFF))):
        c = block + cell.astype(np.int64)
        found &= (bits[depth, c >> 3] >> (c & 7).astype(np.uint8)) & 1 == 1
    return found
