"""Embedding near-duplicates by Euclidean p-stable hashing and exact cosine checks.

On unit vectors a cosine of at least ``cosine`` is a distance of at most sqrt(2 - 2 cosine).  Each of ``tables`` tables
hashes a vector by ``functions`` quantised random projections floor((a v + b) / width); vectors of one bucket are
compared exactly, in double precision.  With the defaults a pair at the very threshold is missed by all tables with
probability 7e-5, a closer pair far less often; a pair below the threshold is never linked.

A bucket is cut into blocks of ``block`` rows and each pair of blocks is one unit of work, so no task holds a hot bucket.
Within a unit only numbers per vector and a spanning forest of its links leave the task, never pairs.  A pair that meets
in several tables counts in the first of them: every row carries its buckets of all tables.  Equal vectors are one class
before hashing, weighted by their number.

Vectors that are null, empty, zero or hold a null or non-finite component link with nothing, and vectors of different
length never link.  Rows that repeat a vec_id are one vector, the smallest of theirs in array order, and get equal
results; a null vec_id has no links.  Extra columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from timelane.llm.common import edge_components, read, stage
from timelane.llm.vectors import by_length, matrix

COSINE, TABLES, FUNCTIONS, WIDTH, SEED = 0.95, 32, 10, 2.0, 11
BLOCK = 1024


def bucketed(vectors: DataFrame, tables: int, functions: int, width: float, seed: int) -> DataFrame:
    """``vectors`` with ``buckets``: one 32-bit name per table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch["dim"].to_numpy()
            names = np.zeros((len(dims), tables), dtype=np.int32)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                rng = np.random.default_rng([seed, int(dim)])
                lines = rng.normal(size=(int(dim), tables * functions))
                shift = rng.uniform(0, width, tables * functions)
                mixers = rng.integers(1, 1 << 62, functions, dtype=np.int64).astype(np.uint64) | np.uint64(1)
                x = matrix(batch["v"].take(pa.array(at)))
                x = x / norms(x)[:, None]
                cells = np.floor((x @ lines + shift) / width).astype(np.int64).astype(np.uint64).reshape(len(at), tables, functions)
                names[at] = ((cells * mixers).sum(axis=2) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(dims) + 1) * tables, pa.int32()), pa.array(names.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, flat], names=[*batch.schema.names, "buckets"])

    return vectors.mapInArrow(run, vectors.withColumn("buckets", F.array(F.lit(0))).schema)


def norms(x: np.ndarray) -> np.ndarray:
    """Lengths; scaled first, so that neither huge nor tiny components overflow."""
    top = np.abs(x).max(axis=1)
    return top * np.sqrt(((x / top[:, None]) ** 2).sum(axis=1))


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that join different trees, at most one less than there are vectors."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = top(x), top(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def compared(rows: DataFrame, cosine: float) -> DataFrame:
    """(id, other, n): links of ``id`` found in one unit of work (other null), and links of its forest (n = 0)."""

    def solve(unit: list[tuple]) -> Iterator[pa.RecordBatch]:
        table, _, x, y, _ = unit[0][0]
        ids = np.array([u[1] for u in unit], dtype=np.int64)
        weight = np.array([u[2] for u in unit], dtype=np.int64)
        block = np.array([u[3] for u in unit])
        v = np.array([u[4] for u in unit], dtype=np.float64)
        v = v / norms(v)[:, None]
        names = np.array([u[5] for u in unit], dtype=np.int32)
        left = np.flatnonzero(block == x)
        right = left if x == y else np.flatnonzero(block == y)
        count = np.zeros(len(ids), dtype=np.int64)
        links = []
        for at in range(0, len(left), 256):
            some = left[at : at + 256]
            i, j = np.nonzero(v[some] @ v[right].T >= cosine)
            i, j = some[i], right[j]
            keep = i < j if x == y else i != j
            # Two vectors that share an earlier table's bucket have been counted there.
            i, j = i[keep], j[keep]
            first = (names[i] == names[j]).argmax(axis=1) if len(i) else i
            i, j = i[first == table], j[first == table]
            np.add.at(count, i, weight[j])
            np.add.at(count, j, weight[i])
            links += forest(ids[i], ids[j])
        found = np.flatnonzero(count)
        if len(found):
            a, b = zip(*forest(*np.array(links, dtype=np.int64).T)) if links else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array([*ids[found].tolist(), *a], pa.int64()), pa.array([*[None] * len(found), *b], pa.int64()), pa.array([*count[found].tolist(), *[0] * len(a)], pa.int64())],
                names=["id", "other", "n"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("table", "bucket", "x", "y", "dim", "id", "weight", "block")]
            v, names = batch["v"].to_pylist(), batch["buckets"].to_pylist()
            for i, (table, bucket, x, y, dim, *rest) in enumerate(zip(*columns)):
                name = (table, bucket, x, y, dim)
                if held and held[-1][0] != name:
                    if len(held) > 1:
                        yield from solve(held)
                    held = []
                held.append((name, *rest, v[i], names[i]))
        if len(held) > 1:
            yield from solve(held)

    unit = ["table", "bucket", "x", "y", "dim"]
    return rows.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(run, "id bigint, other bigint, n bigint")


def near_duplicates(
    embeddings: DataFrame, cosine: float = COSINE, tables: int = TABLES, functions: int = FUNCTIONS, width: float = WIDTH, seed: int = SEED, block: int = BLOCK
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    least = by_length(embeddings, "vec_id", "embedding").groupBy("vec_id").agg(F.min(F.struct("v", "dim")).alias("m")).select("vec_id", "m.v", "m.dim")
    classes = least.groupBy("v", "dim").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"))
    named = stage(bucketed(classes, tables, functions, width, seed), "vectors")
    met = named.select("id", "dim", F.posexplode("buckets").alias("table", "bucket"))
    sizes = met.groupBy("table", "bucket", "dim").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = met.join(sizes, ["table", "bucket", "dim"]).withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    shared = shared.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    shared = shared.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = shared.select("id", "dim", "table", "bucket", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))
    units = spread.join(named.drop("dim"), "id")
    found = stage(compared(units, cosine), "cosines")
    counts = found.where("other IS NULL").groupBy("id").agg(F.sum("n").alias("n"))
    labels = edge_components(found.where("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b")))
    facts = named.select("v", "id", "weight").join(counts, "id", "left").join(labels, "id", "left")
    facts = facts.select("v", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n"), F.coalesce("component", "id").alias("component"))
    facts = least.join(facts, "v").select("vec_id", "n", "component")
    out = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id")).join(facts, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read(spark, folder, "embeddings"))


ORACLE_SQL = """
WITH RECURSIVE
unit AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[64]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id AND array_cosine_similarity(a.v, b.v) >= 0.95),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.b FROM reach r JOIN links l ON r.y = l.a),
lowest AS (SELECT x, min(y) AS c FROM reach GROUP BY x)
SELECT e.vec_id, coalesce(n, 0) AS n_links, c AS component_id, c = e.vec_id AS kept
FROM embeddings e LEFT JOIN counts ON a = e.vec_id JOIN lowest ON x = e.vec_id
"""
