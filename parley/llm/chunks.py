"""Chunks of a partition's texts, and packed arrays of keys that go between chunks and key ranges.

A chunk is a run of a partition's rows with some MB of text. It is named by the partition and its number,
so a table whose partitions give the same rows in the same order has the same chunks whenever it is read.
"""

import ctypes
import gc

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import SparkSession

CHUNK_BYTES = 8_000_000
#: Of an Arrow batch between the JVM and a worker. Spark's own limit lets the texts of a whole task be one batch, which
#: then stands in the JVM's native memory, in the worker as Arrow and there as strings.
BATCH_BYTES = 4_000_000
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_BYTES at most, unless the session has a limit of its own. Rows and their order stay."""
    if spark.conf.get(_BATCH, None) in (None, "64MB", "67108864b", "67108864"):
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def chunk_rows(batches, size: int = CHUNK_BYTES):
    """(chunk number, its rows) in the order of the partition; a chunk may come in several parts. Rows get
    their number in the partition as `row`."""
    seen, row = 0, 0
    for b in batches:
        b = b.assign(text=b["text"].fillna(""), row=np.arange(row, row + len(b)))
        row += len(b)
        sizes = b["text"].map(lambda t: len(t.encode("utf-8"))).to_numpy(np.int64)
        before = seen + np.cumsum(sizes) - sizes
        seen += int(sizes.sum())
        for c, part in b.groupby(before // size, sort=True):
            yield int(c), part


def block_of(chunk: int) -> int:
    """A chunk's name in this task; its lowest bit is free."""
    return (TaskContext.get().partitionId() << 24) | (chunk << 1)


def pack(a: np.ndarray) -> bytes:
    """Non-negative integers, byte plane by byte plane."""
    wide = np.ascontiguousarray(a.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(wide).tobytes())


def unpack(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def range_ends(keys: np.ndarray, ranges: int, bits: int) -> np.ndarray:
    """Where each of `ranges` equal ranges of keys of so many bits begins in the sorted `keys`, and the end."""
    top = min(bits, 32)
    r = ((keys >> np.uint64(bits - top)) * np.uint64(ranges)) >> np.uint64(top)
    return np.searchsorted(r, np.arange(ranges + 1, dtype=np.uint64))


_KEPT: dict[str, dict] = {}


def kept_answers(name: str) -> dict:
    """What the operator of this name keeps in a worker process from task to task; it goes when another operator
    releases memory."""
    return _KEPT.setdefault(name, {})


def release_memory(own: str | None = None) -> None:
    """Give memory that earlier tasks of this worker process have freed back to the system, with the answers that
    operators keep here, those of `own` apart."""
    for name, answers in _KEPT.items():
        if name != own:
            answers.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def key_check(keys: np.ndarray) -> int:
    """A checksum of keys in their order, as a signed 64-bit number."""
    return xxhash.xxh3_64_intdigest(np.ascontiguousarray(keys).tobytes()) - (1 << 63)
