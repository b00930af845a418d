"""Bitmaps of a fixed size that mark 64-bit keys, for leaving out rows ahead of a shuffle.

A key that is marked is found; others are found by chance, more of them as the bitmap fills.
So a bitmap saves work, and what it lets through is joined with the keys themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# 8 MB, for any number of keys.
BITS = 26
_BLOCK = 16
_MIX = np.uint64(0x9E3779B97F4A7C15)


def positions(keys: np.ndarray) -> np.ndarray:
    """The bit of each unsigned 64-bit key."""
    return ((keys * _MIX) >> np.uint64(64 - BITS)).astype(np.int64)


def blocks(keys: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (block, bits) that mark the keys."""
    bits = positions(keys)
    for block in np.unique(bits >> _BLOCK):
        some = np.zeros(1 << _BLOCK, np.uint8)
        some[bits[bits >> _BLOCK == block] & ((1 << _BLOCK) - 1)] = 1
        yield pa.record_batch(
            [pa.array([block], pa.int32()), pa.array([np.packbits(some).tobytes()], pa.binary())],
            names=["block", "bits"],
        )


def _any(rows: pa.Table) -> pa.Table:
    total = np.zeros(1 << (_BLOCK - 3), np.uint8)
    for bits in rows["bits"]:
        total |= np.frombuffer(bits.as_buffer(), np.uint8)
    return pa.table({"block": rows["block"][:1], "bits": pa.array([total.tobytes()], pa.binary())})


def gathered(marks: DataFrame) -> bytes:
    """The bitmap of all rows (block, bits)."""
    out = bytearray(1 << (BITS - 3))
    size = 1 << (_BLOCK - 3)
    for row in marks.groupBy("block").applyInArrow(_any, "block int, bits binary").toLocalIterator():
        out[row.block * size : (row.block + 1) * size] = row.bits
    return bytes(out)


def marked(bitmap: bytes, keys: np.ndarray) -> np.ndarray:
    """Whether the bit of each key is set."""
    bit = positions(keys)
    held = np.frombuffer(bitmap, np.uint8)
    return (held[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 == 1
