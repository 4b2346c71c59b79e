"""Counts over a fixed number of buckets, gathered from all rows with little traffic.

Each task keeps one array of counts and sends it once, in slices; the slices
are summed in parallel.  The result has a fixed size whatever the data.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLICES = 32
SCHEMA = "slice int, counts binary"


def sliced(counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """A task's counts as (slice, compressed counts); empty slices are left out."""
    for i, part in enumerate(np.split(counts, SLICES)):
        if part.any():
            yield i, zlib.compress(part.astype("<u4").tobytes(), 1)


def _add(key: tuple, group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in group:
        for data in batch.column("counts"):
            part = np.frombuffer(zlib.decompress(data.as_py()), dtype="<u4").astype("<i8")
            total = part if total is None else total + part
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[0].as_py()], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], ["slice", "counts"])


def summed(parts: DataFrame, buckets: int) -> np.ndarray:
    """All tasks' slices (columns of ``SCHEMA``) summed; at most ``SLICES`` rows reach the driver."""
    out = np.zeros(buckets, dtype=np.int64)
    width = buckets // SLICES
    for row in parts.select("slice", "counts").groupBy("slice").applyInArrow(_add, SCHEMA).toLocalIterator():
        out[row["slice"] * width:(row["slice"] + 1) * width] = np.frombuffer(zlib.decompress(row["counts"]), dtype="<i8")
    return out


def _mark(bits: int, name: str):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = np.zeros(bits // 8, dtype=np.uint8)          # one bit a bit: bounded by ``bits / 8`` bytes a worker
        for batch in batches:
            at = np.unique(batch.column(name).to_numpy().view(np.uint64) & np.uint64(bits - 1))
            np.bitwise_or.at(packed, (at >> np.uint64(3)).astype(np.int64), np.uint8(128) >> (at & np.uint64(7)).astype(np.uint8))
        for i, part in enumerate(np.split(packed, SLICES)):
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], ["slice", "counts"])

    return run


def _either(key: tuple, group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in group:
        for data in batch.column("counts"):
            part = np.frombuffer(zlib.decompress(data.as_py()), dtype=np.uint8)
            total = part if total is None else total | part
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[0].as_py()], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], ["slice", "counts"])


def bits_for(count: int, per_key: int = 16, most: int = 1 << 28) -> int:
    """Bits of a bitmap of ``count`` keys: a power of two, ``per_key`` bits a key while that stays below ``most``."""
    bits = 1 << 20
    while bits < per_key * count and bits < most:
        bits *= 2
    return bits


def bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """Packed bits of the values of a one-column long table, by their lowest bits (``bits`` is a power of two)."""
    out = np.zeros(bits // 8, dtype=np.uint8)
    width = len(out) // SLICES
    marks = keys.mapInArrow(_mark(bits, keys.columns[0]), SCHEMA)
    for row in marks.groupBy("slice").applyInArrow(_either, SCHEMA).toLocalIterator():
        out[row["slice"] * width:(row["slice"] + 1) * width] = np.frombuffer(zlib.decompress(row["counts"]), dtype=np.uint8)
    return out


def in_bitmap(packed: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the (64-bit) keys may be in the table that the bitmap was made of; never false for one that is."""
    at = keys.view(np.uint64) & np.uint64(len(packed) * 8 - 1)
    return (packed[(at >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1 > 0
