"""Helpers for work on Arrow batches with numpy inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.session import scratch_path

U64 = np.uint64
#: Odd multipliers of the hashes.
SPREAD, STEP = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Text handled at once inside a task.
PIECE_BYTES = 1 << 20


def reach(spark: SparkSession) -> None:
    """Let Python workers import this package where they see the driver's folders; hand them rows in smaller batches than usual, as
    a row holds a whole text or set."""
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "1000")
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(":")
    if root not in paths:
        env["PYTHONPATH"] = ":".join([root, *filter(None, paths)])


def settle(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the shared folder: lost executors don't bring the work back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow types that Spark expects of columns declared so; parts of nested ones may be missing."""
    return to_arrow_schema(StructType.fromDDL(ddl))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values; different values stay different."""
    x = x ^ (x >> U64(32))
    x = x * STEP
    x = x ^ (x >> U64(29))
    x = x * SPREAD
    return x ^ (x >> U64(32))


def byte_table(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(2 * seed + 1))


def as_binary(column) -> pa.LargeBinaryArray:
    """Texts as UTF-8 bytes, missing ones empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string()).cast(pa.large_binary())
    return pc.fill_null(column.cast(pa.large_binary()), b"")


def buffers(column: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in a row, and where each value begins (one more entry than values)."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[at[0] : at[-1]], at - at[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of values of about `limit` bytes; a longer value is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


def text_pieces(column, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of texts with their bytes and their begins within them."""
    data, at = buffers(as_binary(column))
    for lo, hi in pieces(at, limit):
        yield lo, hi, data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]


def _marks(letters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(letters)] = True
    return table


#: Bytes of words: digits, letters and all beyond ASCII; and everything but ASCII white space.
PLAIN_WORDS = _marks(bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]))
SPACED_WORDS = ~_marks(b" \t\n\v\f\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class Words:
    """The words of some texts: hash, begin and end of each, and where each text's words begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = PLAIN_WORDS, lower: bool = True, seed: int = 7):
        inside = kind[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = offsets[:-1][offsets[:-1] < len(data)]
        first[begins] = inside[begins]
        self.start = np.flatnonzero(first)
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        ends = offsets[1:][offsets[1:] > 0] - 1
        last[ends] = inside[ends]
        self.end = np.flatnonzero(last) + 1
        self.at = np.searchsorted(self.start, offsets)
        self.hash = np.zeros(len(self.start), U64)
        size = self.end - self.start
        power = np.cumprod(np.full(int(size.max(initial=0)) + 1, SPREAD, U64))
        table = byte_table(seed)
        if lower:
            table = table[LOWER]
        ends = np.cumsum(size)
        lo = 0
        while lo < len(size):  # some words at once, as this takes several times the room of their bytes
            done = ends[lo] - size[lo]
            hi = max(lo + 1, int(np.searchsorted(ends, done + PIECE_BYTES, "right")))
            group = ends[lo:hi] - size[lo:hi] - done
            place = np.arange(ends[hi - 1] - done) - np.repeat(group, size[lo:hi])
            where = place + np.repeat(self.start[lo:hi], size[lo:hi])
            sums = np.add.reduceat(table[data[where]] * power[place], group)
            self.hash[lo:hi] = mix(sums + size[lo:hi].astype(U64))
            lo = hi

    def __len__(self) -> int:
        return len(self.start)


def grams(symbols: np.ndarray, k: int) -> np.ndarray:
    """A hash of every `k` symbols in a row (nothing for fewer)."""
    n = len(symbols) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = symbols[:n].copy()
    for j in range(1, k):
        out *= SPREAD
        out += symbols[j : j + n]
    return mix(out)


#: Bits of a place among the keys of `leftmost`.
PLACE_BITS = 24


def leftmost(values: np.ndarray, width: int) -> np.ndarray:
    """For every `width` values in a row the place of the smallest, the leftmost of equals.

    Values are compared by their upper 40 bits, at most 2**24 at once.
    """
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    if len(values) >= 1 << PLACE_BITS:
        raise ValueError("too many values at once")
    mask = U64((1 << PLACE_BITS) - 1)
    low = (values & ~mask) | np.arange(len(values), dtype=U64)
    reach_ = 1
    while reach_ * 2 <= width:
        low = np.minimum(low[:-reach_], low[reach_:])
        reach_ *= 2
    if reach_ < width:
        low = np.minimum(low[: n], low[width - reach_ :][:n])
    return (low[:n] & mask).astype(np.int64)
