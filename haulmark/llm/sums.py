"""Adding up one array per partition without gathering all of them in one place."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

WIDTH = 1 << 14


def blocks(total: np.ndarray) -> pa.RecordBatch:
    """A flat array as rows (block, part) of ``WIDTH`` numbers each."""
    flat = np.ascontiguousarray(total, np.float64).reshape(-1)
    cut = [flat[i : i + WIDTH].tobytes() for i in range(0, len(flat), WIDTH)]
    return pa.RecordBatch.from_arrays([pa.array(range(len(cut)), pa.int32()), pa.array(cut, pa.binary())], names=["block", "part"])


SCHEMA = "block int, part binary"


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, part in zip(batch.column("block").to_pylist(), batch.column("part"), strict=True):
            values = np.frombuffer(part.as_buffer(), np.float64)
            held[block] = held[block] + values if block in held else values.copy()
    if held:
        keys = sorted(held)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([held[k].tobytes() for k in keys], pa.binary())], names=["block", "part"])


def summed(parts: DataFrame, size: int, fan_in: int = 32) -> np.ndarray:
    """The sum of all arrays of ``size`` numbers in ``parts``, by rounds of ``fan_in``; the last few sums come to the driver, one array's size each."""
    parts_left = parts.rdd.getNumPartitions()
    while parts_left > fan_in:
        parts_left = -(-parts_left // fan_in)
        parts = parts.repartition(parts_left).mapInArrow(_merge, SCHEMA)
    out = np.zeros(size)
    for row in parts.repartition("block").mapInArrow(_merge, SCHEMA).toLocalIterator():
        values = np.frombuffer(bytes(row["part"]), np.float64)
        out[row["block"] * WIDTH : row["block"] * WIDTH + len(values)] += values
    return out
