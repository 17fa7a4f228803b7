"""Approximate nearest neighbours with a permutation index.

Every vector is represented by its ``near`` nearest of ``pivots`` pivots, in order of nearness.  A pivot's inverted file
posts the vectors that name it, with the place at which they do.  A query merges the files of its own pivots and ranks
what it meets by Spearman's footrule between the two orders (a pivot missing from one counts as place ``near``); the
``candidates`` best, with all ties, are ranked again by the exact inner product in double precision.

Orders see angles only, an inner product also grows with length.  So every shard learns from ``CALIBRATED`` of its rows
which cosine a footrule stands for, and how far cosines scatter around it; a candidate's rank is its length times that
cosine plus two such deviations.  Between vectors of one length that is the order by footrule.

Pivots are a bounded sample of ``pivots`` vectors by hash of vec_id; every vector is indexed.  The index is cut into
shards by hash; each block of queries meets each shard once, a shard and a block are one unit of work, only the shard's best ``k`` per query leave the task, and they
are merged.  No shard or block grows with the data, equal orders (a hot pivot) only make ties, and ties are all kept.

Vectors that are null, empty, zero or hold a null or non-finite component take no part, as query or candidate, nor do
rows with a null vec_id.  Only vectors of equal length are compared.  Rows that repeat a vec_id are one vector, the
smallest of theirs in array order.  Extra columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from timelane.llm.common import read, stage
from timelane.llm.vectors import by_length, matrix

PIVOTS, NEAR, CANDIDATES, K = 128, 32, 2500, 20
SHARD_ROWS, BLOCK_ROWS = 8192, 8192
CALIBRATED, DEVIATIONS = 32, 2.0


def orders(vectors: DataFrame, pivots: dict[int, np.ndarray], near: int) -> DataFrame:
    """``vectors`` with ``order``: the nearest pivots (largest inner product), nearest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch["dim"].to_numpy()
            out: list = [None] * len(dims)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                close = matrix(batch["v"].take(pa.array(at))) @ pivots[int(dim)].T
                best = np.argsort(-close, axis=1, kind="stable")[:, :near].astype(np.int16)
                for i, row in zip(at, best):
                    out[i] = row.tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int16()))], names=[*batch.schema.names, "order"])

    return vectors.mapInArrow(run, vectors.withColumn("order", F.array(F.lit(0).cast("smallint"))).schema)


class Shard:
    """Inverted files of one shard: per pivot the rows that name it and the places at which they do."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, order: np.ndarray, pivots: int):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[by_id], vectors[by_id]
        order = order[by_id]
        rows, places = np.indices(order.shape)
        sort = np.argsort(order.ravel(), kind="stable")
        self.rows, self.places = rows.ravel()[sort], places.ravel()[sort]
        self.start = np.searchsorted(order.ravel()[sort], np.arange(pivots + 1))
        self.near = order.shape[1]
        self.length = np.sqrt((self.vectors**2).sum(axis=1))
        some = np.linspace(0, len(ids) - 1, min(CALIBRATED, len(ids))).astype(np.int64)
        shared = np.concatenate([self.shared(order[i]) for i in some])
        cosine = np.concatenate([self.vectors @ self.vectors[i] / self.length / self.length[i] for i in some])
        # A cubic through the sample; less footrule never stands for a smaller cosine.
        most = self.near * (self.near + 1)
        curve = np.linalg.lstsq(np.vander(shared / most, 4), cosine, rcond=None)[0]
        scatter = (cosine - np.vander(shared / most, 4) @ curve).std()
        self.hoped = np.maximum.accumulate(np.vander(np.arange(most + 1) / most, 4) @ curve) + DEVIATIONS * scatter

    def shared(self, order: np.ndarray) -> np.ndarray:
        """By how much each row's footrule to ``order`` lies below that of a row that shares no pivot."""
        near = self.near
        # A row that shares no pivot has this footrule; each shared pivot takes off what it is nearer.
        saved = np.zeros(len(self.ids), dtype=np.int64)
        for place, pivot in enumerate(order.tolist()):
            part = slice(self.start[pivot], self.start[pivot + 1])
            there = self.places[part]
            saved[self.rows[part]] += (near - place) + (near - there) - np.abs(there - place)
        return saved

    def search(self, own: int, vector: np.ndarray, order: np.ndarray, candidates: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        chosen = np.arange(len(self.ids))
        if len(chosen) > candidates:
            promise = self.length * self.hoped[self.shared(order)]
            chosen = np.flatnonzero(promise >= np.partition(promise, len(promise) - candidates)[len(promise) - candidates])
        chosen = chosen[self.ids[chosen] != own]
        score = self.vectors[chosen] @ vector
        if len(chosen) > k:
            bar = np.partition(score, len(score) - k)[len(score) - k]
            chosen, score = chosen[score >= bar], score[score >= bar]
        best = np.argsort(-score, kind="stable")[:k]
        return self.ids[chosen[best]], score[best]


def nearest(
    embeddings: DataFrame, is_query: Column, k: int = K, pivots: int = PIVOTS, near: int = NEAR, candidates: int = CANDIDATES, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row for which ``is_query`` (on vec_id) holds."""
    least = by_length(embeddings, "vec_id", "embedding").groupBy("vec_id").agg(F.min(F.struct("v", "dim")).alias("m")).select("vec_id", "m.v", "m.dim")
    vectors = stage(least, "vectors")
    facts = vectors.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).collect()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not facts:
        return embeddings.sparkSession.createDataFrame([], schema)
    # At most ``pivots`` vectors for each vector length.
    sample: dict[int, np.ndarray] = {}
    first = Window.partitionBy("dim").orderBy(F.xxhash64("vec_id"), "vec_id")
    picked = vectors.withColumn("turn", F.row_number().over(first)).where(F.col("turn") <= pivots).orderBy("dim", "turn").select("dim", "v").collect()
    for dim in {r["dim"] for r in picked}:
        x = np.array([r["v"] for r in picked if r["dim"] == dim], dtype=np.float64)
        sample[dim] = x / np.sqrt((x**2).sum(axis=1, keepdims=True))
    named = stage(orders(vectors, sample, near), "orders")
    shards = max(1, -(-max(f["n"] for f in facts) // shard_rows))
    blocks = max(1, -(-max(f["q"] for f in facts) // block_rows))
    shard, block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).cast("int"), F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).cast("int")
    columns = ["dim", "shard", "block", "asks", "vec_id", "v", "order"]
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    stored = named.withColumn("asks", F.lit(False)).withColumn("shard", shard).withColumn("block", every(blocks)).select(*columns)
    asked = named.where(is_query).withColumn("asks", F.lit(True)).withColumn("block", block).withColumn("shard", every(shards)).select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, index, held = None, None, []
        width = {dim: len(p) for dim, p in sample.items()}

        def built() -> Shard:
            ids = np.concatenate([h[0] for h in held])
            return Shard(ids, np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held]), width[name[0]])

        for batch in batches:
            units = np.stack([batch[c].to_numpy() for c in ("dim", "shard", "block")], axis=1)
            asks = batch["asks"].to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((units[1:] != units[:-1]).any(axis=1) | (asks[1:] != asks[:-1])) + 1
            for x, y in zip(np.append(0, cuts), np.append(cuts, len(asks))):
                if x == y:
                    continue
                part = batch.slice(x, y - x)
                if tuple(units[x]) != name:
                    name, index, held = tuple(units[x].tolist()), None, []
                ids, v = part["vec_id"].to_numpy(), matrix(part["v"])
                order = part["order"].flatten().to_numpy().reshape(len(part), -1)
                if not asks[x]:
                    held.append((ids, v, order))
                    continue
                if not held:
                    continue
                index = index or built()
                found = [index.search(i, q, o, candidates, k) for i, q, o in zip(ids, v, order)]
                sizes = [len(f[0]) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, sizes)), pa.array(np.concatenate([f[0] for f in found])), pa.array(np.concatenate([f[1] for f in found]))], names=["query_id", "vec_id", "score"]
                )

    dealt = stored.unionByName(asked).repartition("dim", "shard", "block").sortWithinPartitions("dim", "shard", "block", "asks")
    hits = dealt.mapInArrow(run, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(read(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)
