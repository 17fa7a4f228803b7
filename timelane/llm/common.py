"""Helpers of the operators: session, staged tables, hot-safe components, and NumPy views of Arrow text.

Texts are read as Arrow buffers: the words of a whole slice of documents become arrays of byte positions and hashes
at once.  A slice is cut at ``SLICE_BYTES`` so that a task needs memory for one slice, or for its longest text.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from timelane.session import stage, tune

SLICE_BYTES = 1 << 20
#: Odd multipliers of the hashes; any fixed odd values do.
ROOT, MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers = np.ones(1, dtype=np.uint64)

__all__ = [
    "SLICE_BYTES", "Words", "components", "crc32_text", "edge_components", "mix", "ngram_hash", "read", "row_key",
    "slices", "stage", "tune", "word_table", "worker_cache", "utf8_column",
]


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return tune(spark).read.parquet(f"{folder}/{table}.parquet")


def row_key(*columns: str) -> Column:
    """One number per different content of a row; equal rows share it and get equal results."""
    return F.xxhash64(*columns)


def worker_cache() -> dict:
    """Kept by a worker process from task to task; functions travel by value, so their own globals are not."""
    return sys.modules.setdefault("_timelane_cache", types.ModuleType("_timelane_cache")).__dict__


def crc32_text(column: str) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


# ---------------------------------------------------------------- words of Arrow text


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        step = np.full(max(n, 1 << 12), ROOT, dtype=np.uint64)
        step[0] = 1
        _powers = np.multiply.accumulate(step)
    return _powers[:n]


def ngram_hash(values: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n neighbouring values."""
    if len(values) < n:
        return np.zeros(0, dtype=np.uint64)
    weights, total = powers(n), np.zeros(len(values) - n + 1, dtype=np.uint64)
    for j in range(n):
        total += values[j : len(values) - n + 1 + j] * weights[j]
    return mix(total)


def utf8_column(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and the row bounds of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8), bounds


def slices(bounds: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes."""
    first = 0
    while first < len(bounds) - 1:
        last = int(np.searchsorted(bounds, bounds[first] + size, side="right")) - 1
        last = max(last, first + 1)
        yield first, last
        first = last


@dataclass
class Words:
    """Words of some rows: byte range and hash of each, and ``rows``, the word range of every row."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    rows: np.ndarray


def word_table(data: np.ndarray, bounds: np.ndarray, first: int, last: int, lower: bool = False) -> Words:
    """Words (runs of bytes other than 0x20 and 0x09-0x0D) of the rows first..last-1; a word never spans two rows."""
    base, stop = int(bounds[first]), int(bounds[last])
    b = data[base:stop]
    if lower:
        b = np.where((b >= 65) & (b <= 90), b | 32, b).astype(np.uint8)
    solid = ~((b == 32) | ((b >= 9) & (b <= 13)))
    if not solid.any():
        empty = np.zeros(0, dtype=np.int64)
        return Words(b, empty, empty, np.zeros(0, np.uint64), np.zeros(last - first + 1, np.int64))
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    cuts = bounds[first:last] - base
    cuts = cuts[(cuts < len(b))]
    begins[cuts] = solid[cuts]
    at = np.flatnonzero(solid)
    start = np.flatnonzero(begins)
    index = np.searchsorted(at, start)
    lengths = np.diff(np.append(index, len(at)))
    place = np.arange(len(at)) - np.repeat(index, lengths)
    weights = powers(int(lengths.max()))
    sums = np.add.reduceat((b[at].astype(np.uint64) + np.uint64(1)) * weights[place], index)
    hashes = mix(sums + lengths.astype(np.uint64) * MIX_B)
    rows = np.searchsorted(start, bounds[first : last + 1] - base)
    return Words(b, start, start + lengths, hashes, rows)


# ---------------------------------------------------------------- components


def edge_components(edges: DataFrame, a: str = "a", b: str = "b", label: str = "edges") -> DataFrame:
    """(id, component) for every id on an edge: the smallest id that it reaches.

    Alternates large and small stars: every id's neighbours are tied to the smallest of them.  Minima are combined
    before the shuffle, so an id with very many edges is no single group; each round is a staged table.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    current = stage(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label)
    before = None
    while True:
        turned = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = turned.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = turned.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        ties = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("t"))
        current = stage(ties.select("t.*").where("u <> v").distinct(), label)
        facts = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if facts == before:
            break
        before = facts
    own = current.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return current.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(own)


def components(ids: DataFrame, edges: DataFrame, key: str, label: str = "edges") -> DataFrame:
    """``ids`` with a column ``component``; an id without edges is its own."""
    found = edge_components(edges, label=label).withColumnRenamed("id", "__id")
    joined = ids.join(found, F.col(key) == F.col("__id"), "left")
    return joined.withColumn("component", F.coalesce("component", key)).drop("__id")
