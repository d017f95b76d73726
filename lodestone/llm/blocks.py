"""Shared helpers: Arrow text columns as bytes, word hashes, bucketed blobs, written tables."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.session import scratch_path

#: Bytes of text that NumPy code handles at a time; one longer text is handled alone.
SLICE_BYTES = 1 << 20
#: Files of a finished job's shuffles are of no more use once its table is written.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

U64 = np.uint64


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the decimal text of an id, modulo; an id that is null gives 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus, F.lit(0))


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Jobs inside drop their shuffle files when they end, so that the disk holds one job's at a time."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def written(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there and lost executors don't matter.

    ``batch_rows``: rows that go to Python at a time, fewer than usual where a row is large.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(BATCH_ROWS)
    try:
        if batch_rows:
            spark.conf.set(BATCH_ROWS, str(batch_rows))
        with freed_shuffles(spark):
            df.write.parquet(path)
    finally:
        spark.conf.set(BATCH_ROWS, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made and nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(table.written_to)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def bucket_count(spark: SparkSession, factor: int = 2, least: int = 64) -> int:
    """Groups that a shuffle of blobs is dealt into; it follows the partitions the cluster is set to."""
    return max(least, factor * int(spark.conf.get("spark.sql.shuffle.partitions")))


#: What this worker process remembers from task to task, by name.
KEPT: dict[str, object] = {}


def release(but: str | None = None) -> None:
    """At the start of a task: give back what the worker still holds of earlier stages.

    Spark reuses its Python workers, so without this a stage's tables and freed arrays
    would stay beside the next stage's. What is kept under the name ``but`` stays.
    """
    if others := [name for name in KEPT if name != but]:
        for name in others:
            del KEPT[name]
        gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # where the C library has it
        trim(0)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, the offset of each text and whether it is null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    n = len(column)
    null = np.asarray(column.is_null().to_numpy(zero_copy_only=False), dtype=bool)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0], null


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, or of one longer text."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads close values."""
    x = np.asarray(x, U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_WORD = np.zeros(256, bool)
NOT_WORD[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BYTE_CODE = mixed(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=U64)
    return _POWERS["up"], _POWERS["down"]


class Words:
    """The words of some consecutive texts: 64-bit hashes, with the row each is in.

    ``hashes[starts[r]:starts[r + 1]]`` are the words of row ``r``. A-Z count as a-z;
    ``breaks`` marks the bytes that part words.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACE):
        data = LOWER[raw]
        inside = ~breaks[data]
        edge = np.zeros(len(data) + 1, bool)  # a word starts here
        if len(data):
            edge[:-1] = inside
            edge[1:-1] &= ~inside[:-1]
            cut = offsets[1:-1][offsets[1:-1] < len(data)]
            edge[cut] = inside[cut]
        begin = np.flatnonzero(edge[:-1]) if len(data) else np.zeros(0, np.int64)
        stop = np.zeros(len(data) + 1, bool)  # a word ends before here
        if len(data):
            stop[1:] = inside
            stop[1:-1] &= ~inside[1:]
            cut = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] <= len(data))]
            stop[cut] = inside[cut - 1]
        end = np.flatnonzero(stop)
        up, down = _powers(len(data) + 1)
        total = np.zeros(len(data) + 1, U64)
        np.cumsum(_BYTE_CODE[data] * up[: len(data)], out=total[1:])
        self.hashes = mixed((total[end] - total[begin]) * down[begin])
        self.begin, self.end = begin, end
        self.starts = np.searchsorted(begin, offsets)
        self.counts = np.diff(self.starts)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` consecutive words; runs across texts are the caller's to mask."""
    n = max(0, len(hashes) - width + 1)
    out = np.zeros(n, U64)
    for i in range(width):
        out = out * U64(0xD6E8FEB86659FD93) + hashes[i : i + n]
    return mixed(out)


def local_components(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the edges a[i]-b[i]."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(jumped := new[new], new):
            new = jumped
        if np.array_equal(new, label):
            break
        label = new
    return label
