"""Adding up per-task arrays."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "part long, slice int, payload binary"
SLICE_BYTES = 4 * 1024 * 1024  # largest piece that travels in one record
FAN_IN = 64  # partial arrays added by one task
DRIVER_BYTES = 16 * 1024 * 1024  # partial arrays the driver adds itself


def slices(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One task's array as (part, slice, payload) records."""
    from pyspark import TaskContext

    part, flat, step = TaskContext.get().partitionId(), total.ravel(), SLICE_BYTES // 8
    for i, at in enumerate(range(0, len(flat), step)):
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([i], pa.int32()), pa.array([flat[at : at + step].tobytes()])],
            names=["part", "slice", "payload"],
        )


def _add(table: pa.Table) -> pa.Table:
    pieces = table.column("payload").to_pylist()
    total = np.frombuffer(pieces[0]).copy()
    for payload in pieces[1:]:
        total += np.frombuffer(payload)
    part = min(table.column("part").to_pylist())
    return pa.table({"part": pa.array([part], pa.int64()), "slice": table.column("slice").slice(0, 1), "payload": [total.tobytes()]})


def total_of(
    rows: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], np.ndarray], shape: tuple[int, ...]
) -> np.ndarray:
    """Sum of ``partial`` over all tasks, added level by level.

    The result has a fixed shape that does not depend on the number of rows, and
    no task adds more than FAN_IN arrays of one slice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from slices(partial(batches))

    blocks = rows.mapInArrow(run, SCHEMA)
    parts = rows.rdd.getNumPartitions()
    few = max(1, min(FAN_IN, DRIVER_BYTES // (8 * math.prod(shape))))
    while parts > few:
        level = blocks.withColumn("part", F.floor(F.col("part") / FAN_IN))
        blocks = level.groupBy("part", "slice").applyInArrow(_add, SCHEMA)
        parts = -(-parts // FAN_IN)
    found: dict[int, np.ndarray] = {}
    for row in blocks.collect():
        piece = np.frombuffer(row["payload"])
        found[row["slice"]] = found[row["slice"]] + piece if row["slice"] in found else piece
    return np.concatenate([found[i] for i in sorted(found)]).reshape(shape)
