"""Periodic runs of words by uniting suffix classes in order of decreasing common prefix.

A run is a stretch of consecutive words with smallest period q, at least ``max(min_length, 2 q)`` words long, that no
neighbouring word extends.  Two places are in one class at level L when the L words from each of them on are the same.
Classes are united from the highest level downwards, as Kruskal's method unites trees: every pair of neighbours in
suffix order is an edge, weighted by its common prefix.  A class holds its places in order; when the smaller of two is
put into the larger, places that become neighbours at a distance d <= L seed a run of period d that ends L words after
the second place.  No place of the class lies between them, so d is the smallest period; the first seed of an
end and a period, that with the longest prefix, has the run's first word.  A run of ``min_length`` words starts at a
place that shares at least half as many words with the place one period on, so lower levels cannot seed one and are
left out.

Suffixes are sorted by prefix doubling over whole slices of documents, where only tied places are sorted again; the
ranks of every doubling give the common prefixes.  Every document is solved where it is read: nothing is shuffled.  A
task needs memory for one slice of ``SLICE_BYTES``, or for its longest text.

Null, empty and blank texts have no words and no runs.  Repeated rows get equal results row by row, a null doc_id is
kept, extra columns are ignored and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from timelane.llm.common import read, slices, utf8_column

MIN_LENGTH = 12
RESULT = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
DIGEST = "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"

Run = tuple[int, int, int]


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix order of ``symbols`` and the ranks after 1, 2, 4, ... symbols; equal ranks are equal prefixes.

    A text ends where symbols of a greater text number begin, so no prefix reaches over it.
    """
    order = np.argsort(symbols, kind="stable")
    sorted_symbols = symbols[order]
    head = np.append(True, sorted_symbols[1:] != sorted_symbols[:-1])
    slots = np.arange(len(symbols))
    # One place beyond the end ranks above all others.
    rank = np.full(len(symbols) + 1, len(symbols))
    rank[order] = np.maximum.accumulate(np.where(head, slots, 0))
    ranks, step = [rank.copy()], 1
    while True:
        tied = ~(head & np.append(head[1:], True))
        slots, head = slots[tied], head[tied]
        if not len(slots):
            return order, ranks
        places = order[slots]
        group, following = rank[places], rank[np.minimum(places + step, len(symbols))]
        turn = np.lexsort((following, group))
        places, group, following = places[turn], group[turn], following[turn]
        order[slots] = places
        head = np.append(True, (group[1:] != group[:-1]) | (following[1:] != following[:-1]))
        rank[places] = np.maximum.accumulate(np.where(head, slots, 0))
        ranks.append(rank.copy())
        step *= 2


def edges(order: np.ndarray, ranks: list[np.ndarray], least: int) -> tuple[list[int], list[int], list[int]]:
    """Neighbours in suffix order with a common prefix of at least ``least`` symbols, longest first."""
    level = min(least.bit_length() - 1, len(ranks) - 1)
    near = np.flatnonzero(ranks[level][order[1:]] == ranks[level][order[:-1]])
    a, b = order[near], order[near + 1]
    common, last = np.zeros(len(near), dtype=np.int64), len(order)
    for level in range(len(ranks) - 1, -1, -1):
        same = ranks[level][np.minimum(a + common, last)] == ranks[level][np.minimum(b + common, last)]
        common += same.astype(np.int64) << level
    far = np.flatnonzero(common >= least)
    far = far[np.argsort(-common[far], kind="stable")]
    return a[far].tolist(), b[far].tolist(), common[far].tolist()


def seeds(links: tuple[list[int], list[int], list[int]]) -> dict[tuple[int, int], int]:
    """First word by (end, period) of every run that the links, longest first, give."""
    member: dict[int, list[int]] = {}
    found: dict[tuple[int, int], int] = {}
    for a, b, common in zip(*links):
        large, small = member.setdefault(a, [a]), member.setdefault(b, [b])
        if len(large) < len(small):
            large, small = small, large
        before = -1
        for i, place in enumerate(small):
            at = bisect_left(large, place)
            if at and large[at - 1] != before and place - large[at - 1] <= common:
                found.setdefault((place + common, place - large[at - 1]), large[at - 1])
            if at < len(large):
                after = large[at]
                if after - place <= common and (i + 1 == len(small) or small[i + 1] > after):
                    found.setdefault((after + common, after - place), place)
            large.insert(at, place)
            member[place] = large
            before = place
    return found


def runs_of(texts: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[list[Run]]:
    """All runs (start, length, period) of each list of words, by start, then period."""
    out: list[list[Run]] = [[] for _ in texts]
    bounds = np.cumsum([0, *map(len, texts)])
    if not bounds[-1]:
        return out
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    ids = np.fromiter((n for words in texts for n in map(number.__getitem__, words)), dtype=np.int64, count=bounds[-1])
    symbols = np.repeat(np.arange(len(texts)), np.diff(bounds)) * len(number) + ids
    order, ranks = suffix_order(symbols)
    found = [(start, end - start, period) for (end, period), start in seeds(edges(order, ranks, max(1, min_length // 2))).items() if end - start >= min_length]
    owners = np.searchsorted(bounds, [start for start, _, _ in found], side="right") - 1
    for owner, (start, length, period) in zip(owners.tolist(), found):
        out[owner].append((start - int(bounds[owner]), length, period))
    for runs in out:
        runs.sort(key=lambda run: (run[0], run[2]))
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()]


Solved = tuple[int | None, list[bytes], list[Run]]


def solved(docs: DataFrame, rows: Callable[[list[Solved]], pa.RecordBatch], schema: str, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None, min_length: int) -> DataFrame:
    """``rows`` of the (doc_id, words, runs) of every document; ``rewrite`` may change the words first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = utf8_column(batch["text"])
            ids = batch["doc_id"].to_pylist()
            for first, last in slices(bounds):
                # bytes.split cuts at 0x20 and 0x09-0x0D.
                texts = [data[bounds[i] : bounds[i + 1]].tobytes().split() for i in range(first, last)]
                if rewrite:
                    texts = [rewrite(doc_id, words) for doc_id, words in zip(ids[first:last], texts)]
                yield rows(list(zip(ids[first:last], texts, runs_of(texts, min_length))))

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per document: doc_id, n_words, all its runs, and its words without repeated periods."""

    def rows(some: list[Solved]) -> pa.RecordBatch:
        runs = [[dict(zip(("start", "length", "period"), run)) for run in found] for _, _, found in some]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        texts = [b" ".join(collapsed(words, found)).decode() for _, words, found in some]
        return pa.RecordBatch.from_arrays(
            [pa.array([s[0] for s in some], pa.int64()), pa.array([len(s[1]) for s in some], pa.int64()), pa.array(runs, kind), pa.array(texts, pa.string())],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )

    return solved(docs, rows, RESULT, None, min_length)


def tailed(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's input: in a tenth of the documents, by checksum of the id, the words from one place on repeat a first few."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + period] * -(-(n - a) // period))[: n - a]


def digest(doc_id: int | None, words: list[bytes], runs: list[Run]) -> tuple:
    lines = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    top = min(runs, key=lambda run: (-run[1], run[0], run[2])) if runs else None
    return (
        doc_id,
        len(runs),
        *(top or (None,) * 3),
        1000 * top[1] // top[2] if top else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest(),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    def rows(some: list[Solved]) -> pa.RecordBatch:
        columns = zip(*(digest(*one) for one in some))
        kinds = (*[pa.int64()] * 6, pa.string(), pa.string())
        names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return solved(read(spark, folder, "documents"), rows, DIGEST, tailed, MIN_LENGTH)
