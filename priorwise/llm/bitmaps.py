"""Bounded tables of bits that are built in parts and sent to every task."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .kernels import U64, mix

#: A filter never has more bits: 16 MB.
MOST_BITS = 27
_PART_BITS = 15


def slots(values: np.ndarray, bits: int) -> np.ndarray:
    return (mix(values.astype(np.int64).view(U64)) >> U64(64 - bits)).astype(np.int64)


def value_filter(values: DataFrame, column: str) -> Callable[[np.ndarray], np.ndarray]:
    """A test, for arrays of integers, that is true for every value of ``column``.

    It may be true for others.  The table has about 16 bits a value, at most
    2^27 (16 MB), of which parts are filled by tasks and put together here.
    """
    n = values.count()
    bits = int(min(MOST_BITS, max(_PART_BITS, np.ceil(np.log2(16 * n + 1)))))

    def fill(table: pa.Table) -> pa.Table:
        at = table.column("slot").to_numpy() & ((1 << _PART_BITS) - 1)
        part = np.zeros(1 << _PART_BITS, np.uint8)
        part[at] = 1
        return pa.table({"part": table.column("part").slice(0, 1), "filled": pa.array([np.packbits(part, bitorder="little").tobytes()], pa.binary())})

    def place(batches):
        for batch in batches:
            slot = np.unique(slots(batch.column(0).to_numpy(zero_copy_only=False), bits))
            yield pa.record_batch([pa.array(slot), pa.array((slot >> _PART_BITS).astype(np.int32))], names=["slot", "part"])

    placed = values.select(F.col(column).cast("long")).filter(F.col(column).isNotNull()).mapInArrow(place, "slot long, part int")
    parts = placed.groupBy("part").applyInArrow(fill, "part int, filled binary").collect()
    size = (1 << _PART_BITS) // 8
    table = np.zeros((1 << bits) // 8, np.uint8)
    for row in parts:
        table[row["part"] * size : (row["part"] + 1) * size] = np.frombuffer(row["filled"], np.uint8)
    sent = values.sparkSession.sparkContext.broadcast(table)

    def holds(x: np.ndarray) -> np.ndarray:
        at = slots(x, bits)
        return (sent.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0

    return holds
