"""Centroid clustering of whole-number vectors, with nearest centroids found by the threshold algorithm.

Per dimension the centroids' values are sorted once.  A vector stands somewhere in each list and walks outward from
there, in every dimension one centroid a round, always the nearer of the two next ones.  A centroid met for the first
time gets its exact squared distance.  The squared gaps at the frontiers sum to a bound that no centroid unmet so far
can fall below; a vector stops when that sum strictly exceeds the best distance found, or all are met, so a tie is always
met and goes to the smaller number.  All vectors of a batch walk together as NumPy arrays.

Every round is one pass over the vectors: tasks send a sum and a count per centroid and dimension, which Spark adds up.
Only those k x dims totals, a size fixed by the parameters, come to the driver and travel with the next round.  Sums are
exact at any number of vectors (whole numbers of 38 digits), means are their floor; a centroid without vectors stays.

Vectors of another length, null vectors and vectors with a null or non-finite component take no part.  Every row is a
vector, repeated ones included; a null vec_id takes part, but is no starting centroid.  With fewer than ``k`` rows to
start from there are that many centroids, and none give an empty result.  A scaled component must lie within 2^27, so
that distances are whole 64-bit numbers; one beyond is an error.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from timelane.llm.common import read, stage
from timelane.llm.vectors import matrix

CENTROIDS, ROUNDS, DIMS, SCALE, SEED = 40, 5, 64, 256, 2
LIMIT = 1 << 27
#: Vectors that walk together; bounds the memory of a task.
TOGETHER = 512


class Lists:
    """Per dimension: centroids by value, between two ends that are never taken."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        turn = np.argsort(centroids, axis=0, kind="stable")
        ends = np.full((1, centroids.shape[1]), 4 * LIMIT)
        self.names = np.vstack([turn[:1], turn, turn[-1:]]).T.copy()
        self.values = np.vstack([-ends, np.take_along_axis(centroids, turn, axis=0), ends]).T.copy()

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each row of ``x``."""
        rows, dims = x.shape
        k = len(self.centroids)
        below = np.stack([np.searchsorted(self.values[d], x[:, d]) for d in range(dims)], axis=1) - 1
        above = below + 1
        best, winner = np.full(rows, np.iinfo(np.int64).max), np.zeros(rows, dtype=np.int64)
        met = np.zeros((rows, k), dtype=bool)
        active, every = np.arange(rows), np.arange(dims)
        for _ in range(k):
            v, lo, hi = x[active], below[active], above[active]
            down, up = v - self.values[every, lo], self.values[every, hi] - v
            lower = down <= up
            taken = np.where(lower, lo, hi)
            frontier = np.minimum(down, up)
            below[active], above[active] = lo - lower, hi + ~lower
            fresh = np.zeros((len(active), k), dtype=bool)
            fresh[np.arange(len(active))[:, None], self.names[every, taken]] = True
            fresh &= ~met[active]
            met[active] |= fresh
            at, number = np.nonzero(fresh)
            exact = ((v[at] - self.centroids[number]) ** 2).sum(axis=1)
            # One row after another, smaller numbers first: the first least distance of a row is the one to keep.
            turn = np.lexsort((number, exact, at))
            first = turn[np.append(True, at[turn][1:] != at[turn][:-1])] if len(at) else turn
            rows_met, distance, name = active[at[first]], exact[first], number[first]
            better = (distance < best[rows_met]) | ((distance == best[rows_met]) & (name < winner[rows_met]))
            best[rows_met[better]], winner[rows_met[better]] = distance[better], name[better]
            active = active[((frontier**2).sum(axis=1) <= best[active]) & ~met[active].all(axis=1)]
            if not len(active):
                break
        return winner, best


def whole(embeddings: DataFrame, dims: int, scale: int) -> DataFrame:
    """(vec_id, v): vectors that take part, as whole numbers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    kept = embeddings.where((F.size("embedding") == dims) & F.coalesce(finite, F.lit(False)))
    inside = F.forall("embedding", lambda x: F.abs(F.lit(float(scale)) * x.cast("double")) < LIMIT)
    checked = F.when(inside, scaled).otherwise(F.raise_error(F.lit(f"a component lies beyond {LIMIT / scale:.0f}; its distances are no 64-bit numbers")))
    return kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), checked.alias("v"))


def started(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The first centroids: vectors with the smallest digest of seed and number; equal ones by their components."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.where("vec_id IS NOT NULL").select(digest.alias("digest"), "v").orderBy("digest", "v").limit(k)
    return np.array([row.v for row in sorted(first.collect(), key=lambda row: (row.digest, row.v))], dtype=np.int64)


def assigned(centroids: np.ndarray, together: int) -> Callable[[pa.RecordBatch], Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]]:
    lists = Lists(centroids)

    def parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        for at in range(0, batch.num_rows, together):
            part = batch.slice(at, together)
            x = matrix(part["v"]).astype(np.int64)
            yield part, x, *lists.nearest(x)

    return parts


def moved(vectors: DataFrame, centroids: np.ndarray, together: int = TOGETHER) -> np.ndarray:
    """Every centroid at the floor of the mean of its vectors."""
    k, dims = centroids.shape
    parts = assigned(centroids, together)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, counts = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
            for _, x, winner, _ in parts(batch):
                np.add.at(sums, winner, x)
                counts += np.bincount(winner, minlength=k)
            found = np.flatnonzero(counts)
            columns = np.repeat(found, dims), np.tile(np.arange(dims), len(found)), sums[found].ravel(), np.repeat(counts[found], dims)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["cluster", "dim", "total", "n"])

    totals = vectors.select("v").mapInArrow(run, "cluster bigint, dim bigint, total bigint, n bigint")
    sums = totals.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    out = centroids.copy()
    for row in sums.collect():
        out[row.cluster, row.dim] = int(row.total) // row.n
    return out


def clusters(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED, together: int = TOGETHER) -> DataFrame:
    """One row per vector: vec_id, cluster, distance, and the centroid with its number of vectors and their distances."""
    spark = embeddings.sparkSession
    vectors = stage(whole(embeddings, dims, scale), "integers")
    centroids = started(vectors, k, seed)
    schema = "vec_id bigint, cluster int, distance bigint"
    if not len(centroids):
        facts = "centroid array<bigint>, cluster_size bigint, cluster_inertia bigint, inertia bigint"
        return spark.createDataFrame([], f"{schema}, {facts}")
    for _ in range(rounds):
        centroids = moved(vectors, centroids, together)
    parts = assigned(centroids, together)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, winner, best in parts(batch):
                yield pa.RecordBatch.from_arrays([part["vec_id"], pa.array(winner, pa.int32()), pa.array(best, pa.int64())], names=["vec_id", "cluster", "distance"])

    rows = stage(vectors.mapInArrow(run, schema), "clusters")
    distance = F.sum(F.col("distance").cast("decimal(38,0)")).cast("bigint")
    sums = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("cluster_size"), distance.alias("cluster_inertia"))
    # At most k rows.
    found = [(int(r.cluster), centroids[r.cluster].tolist(), r.cluster_size, r.cluster_inertia) for r in sums.collect()]
    total = sum(f[3] for f in found)
    facts = spark.createDataFrame([(*f, total) for f in found], "cluster int, centroid array<bigint>, cluster_size bigint, cluster_inertia bigint, inertia bigint")
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "centroid", "cluster_size", "cluster_inertia", "inertia")


def query(spark: SparkSession, folder: str) -> DataFrame:
    found = clusters(read(spark, folder, "embeddings"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def _round(i: int) -> str:
    """SQL of one round: assignment to centroids c<i>, then centroids c<i + 1>."""
    return f"""
a{i} AS MATERIALIZED (
  SELECT r, arg_min(k, (d, k)) AS k, min(d) AS d
  FROM (SELECT r, k, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM whole, c{i})
  GROUP BY r),
s{i} AS (SELECT k, j, sum(v[j]) AS s, count(*) AS n FROM whole JOIN a{i} USING (r), range(1, 65) t(j) GROUP BY k, j),
m{i} AS (SELECT k, list(((s - (((s % n) + n) % n)) // n)::BIGINT ORDER BY j) AS c FROM s{i} GROUP BY k),
c{i + 1} AS MATERIALIZED (SELECT k, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (k))"""


ORACLE_SQL = f"""
WITH whole AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS k, v AS c
  FROM whole WHERE vec_id IS NOT NULL ORDER BY sha256('2:' || vec_id), v LIMIT {CENTROIDS}),
{",".join(_round(i) for i in range(ROUNDS + 1))}
SELECT vec_id, CAST(a{ROUNDS}.k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY a{ROUNDS}.k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM whole JOIN a{ROUNDS} USING (r) JOIN c{ROUNDS} ON a{ROUNDS}.k = c{ROUNDS}.k
"""
