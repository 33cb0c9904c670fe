"""Shared pieces: the scratch folder, and word hashing over Arrow buffers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
#: Bytes of text that are hashed at a time; bounds the memory of a task.
BLOCK = 4 << 20
SPAN = 1 << 18

_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def scratch(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir, else (tests) one that is set here."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="cytolake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it goes when the session ends."""
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


#: For tables whose rows are megabytes: a row group is closed at 16 MB, looked at row by row. By default it is looked at after 100 rows, so a task would hold all that it writes, and all of a group where it is read.
LARGE_ROWS = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1"}


def materialise(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Writes df as a table in the shared folder and reads it again, which cuts the lineage."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.options(compression="zstd", **(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Gives memory that is free back to the system: a Python worker lives on after its task, and the next stage has workers of its own."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, with the memory that it leaves given back at the end of a task."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SPAN)
        inverse = pow(_BASE, -1, 1 << 64)
        _powers[:] = [np.cumprod(np.concatenate([[U64(1)], np.full(size - 1, b, U64)])) for b in (_BASE, inverse)]
    return _powers[0], _powers[1]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null counts as empty."""
    if column.null_count:
        column = pa.compute.fill_null(column, "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if offsets and len(column) else np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


def text_blocks(column: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows of about `limit` bytes; a longer text is a run of its own."""
    data, offsets = text_buffers(column)
    a, n = 0, len(column)
    while a < n:
        b = min(n, max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1))
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def find_words(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word (no gaps in it: by default no ASCII white space), and its row."""
    inside = ~gaps[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    counts = np.searchsorted(starts, offsets)
    return starts, ends, np.repeat(np.arange(len(offsets) - 1), np.diff(counts))


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word, from prefix sums of a polynomial hash, SPAN bytes at a time."""
    out, a = np.empty(len(starts), U64), 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + SPAN, "right")))
        lo, hi = int(starts[a]), int(ends[b - 1])
        up, down = powers(hi - lo)
        piece = data[lo:hi]
        sums = np.zeros(hi - lo + 1, U64)
        np.cumsum((_LOWER[piece] if lower else piece).astype(U64) * up[: hi - lo] + up[: hi - lo], out=sums[1:])
        i, j = starts[a:b] - lo, ends[a:b] - lo
        out[a:b] = (sums[j] - sums[i]) * down[i]
        a = b
    return mix(out)


def shingle(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words; len - k + 1 values, which may span rows."""
    n = max(0, len(hashes) - k + 1)
    total = np.zeros(n, U64)
    for j in range(k):
        total = total * U64(0xD6E8FEB86659FD93) + hashes[j : j + n]
    return mix(total)


def row_counts(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n).astype(np.int64)
