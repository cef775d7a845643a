"""Helpers shared by the corpus operators: tables cut from their lineage, text as arrays, hashing."""

from __future__ import annotations

import contextlib
import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldmark.session import scratch_path

#: Documents are handled in slices of about this many bytes, so that a task's arrays stay small.
SLICE_BYTES = 1 << 19


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the cluster's shared folder and read it back: its lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcasts(table: DataFrame) -> bool:
    """True if Spark would broadcast a written table, judged by the size of its files."""
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_back(id_column: str, modulus: int, remainder: int) -> Column:
    """True for the ids whose crc32 (of the id as text) leaves ``remainder``; a null id never does."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % modulus == remainder, F.lit(False))


#: What a Python worker keeps from task to task for one operator.
worker_state: dict = {}


def release() -> None:
    """Drop what another operator's tasks have left in this worker."""
    worker_state.clear()


def tidy(made: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """For functions over a task's batches: a worker waits for its next task with little memory.

    Workers outlive their tasks and stages; freed arrays would otherwise stay with them.
    """

    @functools.wraps(made)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from made(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; a null counts as empty.  No copy is made."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows that hold about ``limit`` bytes; a longer text is a run of its own."""
    sizes = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield at, to
        at = to


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words under which near inputs get unlike outputs."""
    # The finaliser of the public splitmix64 generator.
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    global _powers
    if len(_powers[0]) <= n:
        inverse = pow(_BASE, -1, 1 << 64)
        made = []
        for factor in (_BASE, inverse):
            steps = np.full(n + n // 4 + 1024, factor, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        _powers = (made[0], made[1])
    return _powers


class Spans:
    """Hashes of any byte ranges of one buffer, each in constant time and equal for equal bytes."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers_to(len(data) + 1)
        self.sums = np.empty(len(data) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(_BYTE_CODES[data] * up[: len(data)], out=self.sums[1:])

    def raw(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.down[starts]

    def hashed(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix(self.raw(starts, ends) + (ends - starts).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        """The hash of the ``width`` bytes from each start."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[width:] - self.sums[:n]) * self.down[:n])


_WORD_BYTE = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the words: runs of letters, digits and non-ASCII characters.

    Words never cross the rows' borders.
    """
    inside = _WORD_BYTE[data]
    if not inside.any():
        none = np.zeros(0, np.int64)
        return none, none, none
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    borders = offsets[(offsets > 0) & (offsets < len(data))]
    cut_here = np.zeros(len(data) + 1, bool)
    cut_here[borders] = True
    starts = np.flatnonzero(inside & (~before | cut_here[:-1]))
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut_here[1:])) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


_WEIGHTS = mix(np.arange(101, 165, dtype=np.uint64))


def shingles(words: np.ndarray, rows: np.ndarray, n_rows: int, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of each row, and their row numbers.

    ``words`` are word hashes, ``rows`` their ascending row numbers.  A row of fewer
    words has one shingle of all of them; a row without words has none.
    """
    counts = np.bincount(rows, minlength=n_rows)
    padded = np.concatenate([words, np.zeros(width - 1, np.uint64)])
    total = np.zeros(len(words), np.uint64)
    last = np.cumsum(counts)[rows]
    at = np.arange(len(words))
    for k in range(width):
        part = padded[k : k + len(words)] * _WEIGHTS[k]
        total += np.where(at + k < last, part, np.uint64(0)) if k else part
    first = last - counts[rows]
    whole = (at + width <= last) | (at == first)
    return mix(total[whole]), rows[whole]
