"""Vectors packed in blocks, for solvers that pass over the same rows many times.

A block holds whole rows as four packed arrays: positions, values, values per row, labels. A pass reads bytes where
the vectors themselves would be lists of numbers, which cost more to hand over than to compute with.
"""

import ctypes
import gc
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SLICES = 32
BLOCK = "at binary, flat binary, lengths binary, labels binary"
BLOCK_VALUES = 200_000  # numbers of a block of rows
_PART = "slice int, values binary"
_KINDS = ("at", np.int32), ("flat", np.float64), ("lengths", np.int32), ("labels", np.int32)
#: Of an Arrow batch between the JVM and a worker, which stands in the native memory of the one and in the other.
BATCH_BYTES = 4_000_000
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_BYTES at most, unless the session has a limit of its own. Rows and their order stay."""
    if spark.conf.get(_BATCH, None) in (None, "64MB", "67108864b", "67108864"):
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def release_memory() -> None:
    """Give freed memory of a worker back, which lives on for other tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _rows(batch: pa.RecordBatch):
    """(indices, values, row of each value, labels) of a batch of sparse or dense vectors."""
    vectors, labels = batch.column("_p"), batch.column("_label").to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.field("values")
    lengths = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(labels)), lengths)
    flat = values.flatten().to_numpy(zero_copy_only=False)
    indices = vectors.field("indices")
    if indices.null_count:
        first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        dense = np.arange(len(flat)) - np.repeat(first, lengths)
        given = np.repeat(indices.is_valid().to_numpy(zero_copy_only=False), lengths)
        at = dense
        at[given] = indices.flatten().to_numpy(zero_copy_only=False)
    else:
        at = indices.flatten().to_numpy(zero_copy_only=False)
    return at, flat, owner, labels


def as_blocks(batches):
    """For mapInArrow: rows of `_p` (indices, values) and `_label` as blocks of whole rows."""
    for batch in batches:
        ends = np.concatenate(([0], np.cumsum(batch.column("_p").field("values").value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)))
        row = 0
        while row < batch.num_rows:
            stop = max(row + 1, int(np.searchsorted(ends, ends[row] + BLOCK_VALUES, side="right")) - 1)
            at, flat, owner, labels = _rows(batch.slice(row, stop - row))
            parts = at.astype(np.int32), flat.astype(float), np.diff(ends[row:stop + 1]).astype(np.int32), labels.astype(np.int32)
            yield pa.record_batch({name: pa.array([x.tobytes()], pa.binary()) for name, x in zip(("at", "flat", "lengths", "labels"), parts)})
            row = stop
    release_memory()


def in_blocks(batch: pa.RecordBatch, i: int) -> list:
    """Positions, values, values per row and labels of the i-th block of a batch."""
    return [np.frombuffer(batch.column(name)[i].as_buffer(), kind) for name, kind in _KINDS]


def block_sums(data: DataFrame, add_block: Callable, size: int) -> np.ndarray:
    """`size` numbers summed over all blocks: `add_block(sums, at, flat, lengths, labels)` adds those of a block to `sums`.

    A task holds one array of sums; those of all tasks meet in slices, and only the totals come to the driver."""

    def task(batches):
        total = np.zeros(size)
        for batch in batches:
            for i in range(batch.num_rows):
                add_block(total, *in_blocks(batch, i))
        for k, part in enumerate(np.array_split(total, SLICES)):
            yield pa.record_batch({"slice": pa.array([k], pa.int32()), "values": pa.array([part.tobytes()], pa.binary())})

    def add(parts: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_py()) for v in parts["values"])
        return pa.table({"slice": parts["slice"].slice(0, 1), "values": pa.array([total.tobytes()], pa.binary())})

    got = data.mapInArrow(task, _PART).groupBy("slice").applyInArrow(add, _PART).collect()
    return np.concatenate([np.frombuffer(bytes(r["values"])) for r in sorted(got, key=lambda r: r["slice"])]) if got else np.zeros(size)
