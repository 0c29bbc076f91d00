"""What the operators share: tables, the shared folder, bounded batches, word scanning."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import scratch_path

CHUNK_BYTES = 4 << 20  # text handled at once in a task; one longer text is handled alone
MAX_BATCH_BYTES = 16 << 20
GOLD = np.uint64(0x9E3779B97F4A7C15)


def ready(spark: SparkSession) -> SparkSession:
    """Settings the Python stages rely on: Arrow batches bounded by bytes, UTC."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(MAX_BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pieces(spark: SparkSession) -> int:
    """How many pieces a shuffle makes, as the session says."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def settle(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lost executors cost a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: str | Column = "text") -> Column:
    """Tells rows of one doc_id with different texts apart."""
    return F.xxhash64(F.lit("row"), F.col(text) if isinstance(text, str) else text)


def per_worker(name: str, make: Callable):
    """A value kept for the life of a Python worker, across the tasks it runs.

    Functions travel to executors by value, so their module globals start afresh with
    every task; tokenizers and word caches are worth keeping longer.
    """
    state = sys.modules.setdefault("riskloom_worker_state", types.ModuleType("riskloom_worker_state"))
    if not hasattr(state, name):
        setattr(state, name, make())
    return getattr(state, name)


def chunks(batches: Iterable[pa.RecordBatch], column: str | int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose ``column`` (binary or string) holds about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pa.compute.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
        at = (np.cumsum(sizes) - sizes) // limit
        cuts = np.flatnonzero(np.diff(at)) + 1
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows]):
            yield batch.slice(int(a), int(b - a))
    give_back()


def give_back() -> None:
    """Returns freed memory to the system at the end of a task.

    Workers stay for the next stage, and what their allocators keep counts against the
    executor's limit.
    """
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of several texts, one after the other.

    ``buf`` holds all words, each followed by one space; word i is buf[start[i]:end[i]];
    text d has words first[d] to first[d + 1].
    """

    def __init__(self, texts: list[bytes | None]):
        parts = [t or b"" for t in texts]
        raw = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
        gap = (raw == 32) | ((raw >= 9) & (raw <= 13))
        before = np.empty_like(gap)
        before[0], before[1:] = True, gap[:-1]
        starts, ends = np.flatnonzero(~gap & before), np.flatnonzero(gap & ~before)
        offsets = np.cumsum([0] + [len(p) + 1 for p in parts])
        self.first = np.searchsorted(starts, offsets)
        self.length = ends - starts
        self.end = np.cumsum(self.length + 1) - 1
        self.start = self.end - self.length
        kept = np.where(gap, np.uint8(32), raw)[~(gap & before)]
        self.buf = kept.tobytes()
        self.n = len(starts)

    def hashes(self) -> np.ndarray:
        """A 64-bit value of each word. Words of up to 24 bytes are read in full."""
        padded = np.zeros(len(self.buf) + 16, dtype=np.uint8)
        padded[8 : 8 + len(self.buf)] = np.frombuffer(self.buf, dtype=np.uint8)
        eight = np.lib.stride_tricks.as_strided(padded.view(), shape=(len(padded) - 7, 8), strides=(1, 1))

        def load(at: np.ndarray) -> np.ndarray:
            return np.ascontiguousarray(eight[at]).view("<u8").ravel()

        size = np.minimum(self.length, 8).astype(np.uint64)
        mask = np.where(size == 8, np.uint64(2**64 - 1), (np.uint64(1) << (np.uint64(8) * size)) - np.uint64(1))
        head = load(self.start + 8) & mask
        out = mix(head * GOLD + self.length.astype(np.uint64))
        long = np.flatnonzero(self.length > 8)
        if len(long):
            tail = load(self.end[long])
            middle = load(8 + (self.start[long] + self.end[long]) // 2 - 4)
            out[long] = mix(out[long] + tail * GOLD + mix(middle))
        return out


def rolling(values: np.ndarray, width: int, base: int = 0x2545F4914F6CDD1D) -> np.ndarray:
    """A hash of each run of ``width`` values: the sum of value times a power of ``base``."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    inverse = pow(base, -1, 2**64)
    powers = np.full(len(values), base, dtype=np.uint64)
    powers[0] = 1
    back = np.full(n, inverse, dtype=np.uint64)
    back[0] = 1
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * np.cumprod(powers), out=total[1:])
    return mix((total[width:] - total[:-width]) * np.cumprod(back))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def runs(*changes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one-past-last index of each run in which none of the arrays changes."""
    n = len(changes[0])
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    cut = np.zeros(n - 1, dtype=bool)
    for c in changes:
        cut |= c[1:] != c[:-1]
    at = np.flatnonzero(cut) + 1
    return np.r_[0, at], np.r_[at, n]
