"""Line dedup by a sharded minimal perfect hash over distinct line hashes.

A line's key is the line without white space (0x20, 0x09-0x0D) at both ends and with A-Z in lower case.  A key of at
least ``min_chars`` code points that at least ``min_docs`` documents hold loses all its lines except in the document
with the largest id holding it.

Keys are 128-bit digests.  Spark counts the documents of each and keeps the repeated ones, dealt over shards of about
``shard_keys``.  A shard hashes its digests without a gap: level by level every digest names a bit, digests alone at
their bit stay there, the others go on to the next, smaller level; a digest's number is that of the set bits before its
own.  The number indexes three arrays: fingerprint (64 bits, so a foreign line passes once in 2^64), count of documents
and largest document id.  One task builds one shard, some bits and 20 bytes a line.

Documents then probe the arrays where they are read; neither lines nor texts are shuffled.  That takes the arrays to
every task, so their size is checked first: beyond ``broadcast_bytes`` every document's digests go to the shards
instead, in blocks of about ``unit_rows`` with a copy of the shard's arrays each, so a line that a third of all
documents hold is many blocks; what they lose goes back by document.  Both ways give the same rows.

Null and empty texts are one empty line.  Rows that share a doc_id are one document in counts, and each loses its own
lines.  A row without a doc_id is in no count and keeps no repeated line.  Extra columns are ignored, an empty table
gives an empty result.  A task needs memory for the arrays, one slice of texts, or its longest text.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from timelane.llm.common import mix, read, row_key, slices, stage, utf8_column

MIN_CHARS, MIN_DOCS = 40, 5
SHARD_KEYS, BROADCAST_BYTES, UNIT_ROWS = 16_384, 32 << 20, 200_000
SLICE = 8 << 20
#: Bits a level has for each digest that comes to it.
ROOM = 2
BLANKS = b" \t\n\v\f\r"
SHARD = "shard long, levels array<int>, bits binary, prints binary, counts binary, keepers binary"
RESULT = "doc_id bigint, n_lines bigint, n_dropped bigint, kept string"


# ---------------------------------------------------------------- lines and their digests


def key_of(line: bytes, min_chars: int) -> bytes | None:
    """The key of a line, None for one too short.  Lower case of bytes is that of A-Z."""
    key = line.strip(BLANKS)
    if len(key) < min_chars or (not key.isascii() and len(key.decode()) < min_chars):
        return None
    return key.lower()


def digests(keys: Iterable[bytes]) -> np.ndarray:
    """Two 64-bit halves per key."""
    return np.frombuffer(b"".join(hashlib.blake2b(key, digest_size=16).digest() for key in keys), dtype="<u8").reshape(-1, 2)


def texts_of(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[bytes]]]:
    data, bounds = utf8_column(batch["text"])
    for first, last in slices(bounds, SLICE):
        yield first, last, [data[bounds[i] : bounds[i + 1]].tobytes() for i in range(first, last)]


def prepared(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """(k, doc_id, a, b): the digest of every different key of a row; k names the row by its content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in texts_of(batch):
                keys = [{key for line in text.split(b"\n") if (key := key_of(line, min_chars)) is not None} for text in texts]
                at = pa.array(np.repeat(np.arange(first, last), [len(found) for found in keys]))
                halves = digests(key for found in keys for key in found).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch["k"].take(at), batch["doc_id"].take(at), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())], names=["k", "doc_id", "a", "b"]
                )

    return docs.withColumn("k", row_key("doc_id", "text")).mapInArrow(run, "k bigint, doc_id bigint, a bigint, b bigint")


def repeated(lines: DataFrame, min_docs: int) -> DataFrame:
    """(a, b, n, keeper): digests of at least ``min_docs`` documents.  Documents first, so a frequent line is no group."""
    once = lines.where("doc_id IS NOT NULL").select("a", "b", "doc_id").distinct()
    return once.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= min_docs)


# ---------------------------------------------------------------- the hash


def bit_of(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    """The bit that digests name at a level; all 128 bits count."""
    odd = np.uint64(2 * level + 1)
    return (mix(mix(a + odd) ^ (b * odd)) % np.uint64(size)).astype(np.int64)


def print_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a ^ mix(b))


@dataclass
class Shard:
    """Bits of all levels one after another, and the arrays they index."""

    levels: np.ndarray
    bits: np.ndarray
    prints: np.ndarray
    counts: np.ndarray
    keepers: np.ndarray

    def __post_init__(self):
        self.before = np.append(0, np.cumsum(np.bitwise_count(self.bits).astype(np.int64)))

    def place(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of each digest, -1 where no level has its bit; a foreign digest may get one."""
        out, left, base = np.full(len(a), -1), np.arange(len(a)), 0
        for level, size in enumerate(self.levels.tolist()):
            at = base + bit_of(a[left], b[left], level, size)
            word, bit = self.bits[at >> 6], (at & 63).astype(np.uint64)
            there = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[there]] = (self.before[at >> 6] + below)[there]
            left, base = left[~there], base + size
        return out

    def lost(self, a: np.ndarray, b: np.ndarray, doc_id: np.ndarray, known: np.ndarray, min_docs: int) -> np.ndarray:
        """Which lines go: repeated ones of a document that is not their keeper."""
        number = self.place(a, b)
        found, number = number >= 0, np.maximum(number, 0)
        found &= self.prints[number] == print_of(a, b)
        return found & (self.counts[number] >= min_docs) & ~(known & (self.keepers[number] == doc_id))

    @classmethod
    def of(cls, row) -> Shard:
        kinds = (("bits", "<u8"), ("prints", "<u8"), ("counts", "<u4"), ("keepers", "<i8"))
        return cls(np.array(row["levels"]), *(np.frombuffer(row[name], dtype=kind) for name, kind in kinds))

    @classmethod
    def built(cls, a: np.ndarray, b: np.ndarray, counts: np.ndarray, keepers: np.ndarray) -> Shard:
        levels, words, left = [], [], np.arange(len(a))
        while len(left):
            size = 64 * -(-ROOM * len(left) // 64)
            at = bit_of(a[left], b[left], len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(size)
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at]]
        bits, none = np.concatenate(words), np.zeros(0, dtype=np.uint64)
        turn = np.argsort(cls(np.array(levels), bits, none, none, none).place(a, b))
        return cls(np.array(levels), bits, print_of(a, b)[turn], counts[turn].astype("<u4"), keepers[turn].astype("<i8"))


def index(found: DataFrame, shards: int) -> DataFrame:
    """One row per shard: its bits and arrays."""

    def built(name: int, columns: list[np.ndarray]) -> pa.RecordBatch:
        a, b, n, keeper = (np.concatenate(c) for c in columns)
        shard = Shard.built(a.view(np.uint64), b.view(np.uint64), n, keeper)
        arrays = [pa.array([x.tobytes()], pa.binary()) for x in (shard.bits, shard.prints, shard.counts, shard.keepers)]
        return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([shard.levels.tolist()], pa.list_(pa.int32())), *arrays], names=["shard", "levels", "bits", "prints", "counts", "keepers"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, [[], [], [], []]
        for batch in batches:
            shard = batch["shard"].to_numpy()
            columns = [batch[c].to_numpy() for c in ("a", "b", "n", "keeper")]
            cuts = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(shard))
            for first, last in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if name is not None and name != shard[first]:
                    yield built(name, held)
                    held = [[], [], [], []]
                name = int(shard[first])
                for part, column in zip(held, columns):
                    part.append(column[first:last])
        if name is not None:
            yield built(name, held)

    dealt = found.withColumn("shard", F.pmod("a", F.lit(shards)).cast("bigint"))
    return dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, SHARD)


# ---------------------------------------------------------------- probing

Loss = Callable[[pa.RecordBatch, np.ndarray, np.ndarray], np.ndarray]


def ids_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Document ids, and which of them are known."""
    return column.fill_null(0).to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)


def cut(rows: DataFrame, lose: Loss, min_chars: int) -> DataFrame:
    """Documents without the lines that ``lose`` marks, given some rows and the row and digest of each of their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in texts_of(batch):
                lines = [text.split(b"\n") for text in texts]
                keys = [(i, j, key) for i, some in enumerate(lines) for j, line in enumerate(some) if (key := key_of(line, min_chars)) is not None]
                part = batch.slice(first, last - first)
                gone = lose(part, np.array([i for i, _, _ in keys], dtype=np.int64), digests(key for _, _, key in keys))
                dropped = defaultdict(set)
                for at in np.flatnonzero(gone).tolist():
                    dropped[keys[at][0]].add(keys[at][1])
                for i, some in dropped.items():
                    texts[i] = b"\n".join([line for j, line in enumerate(lines[i]) if j not in some])
                counts = [len(some) for some in lines], [len(dropped.get(i, ())) for i in range(len(lines))]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], *(pa.array(c, pa.int64()) for c in counts), pa.array([text.decode() for text in texts], pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept"]
                )

    return rows.mapInArrow(run, RESULT)


def probed(docs: DataFrame, built: DataFrame, shards: int, min_chars: int, min_docs: int) -> DataFrame:
    """Every document probes the arrays, whose size has been checked."""
    held = docs.sparkSession.sparkContext.broadcast([row.asDict() for row in built.collect()])
    loaded: dict[int, Shard] = {}

    def lose(part: pa.RecordBatch, owners: np.ndarray, halves: np.ndarray) -> np.ndarray:
        if not loaded:
            loaded.update((row["shard"], Shard.of(row)) for row in held.value)
        doc_id, known = ids_of(part["doc_id"])
        gone, name = np.zeros(len(owners), dtype=bool), np.mod(halves[:, 0].view(np.int64), shards)
        turn = np.argsort(name, kind="stable")
        for at in np.split(turn, np.flatnonzero(np.diff(name[turn])) + 1):
            if len(at) and (shard := loaded.get(int(name[at[0]]))):
                gone[at] = shard.lost(halves[at, 0], halves[at, 1], doc_id[owners[at]], known[owners[at]], min_docs)
        return gone

    return cut(docs, lose, min_chars)


def routed(docs: DataFrame, lines: DataFrame, built: DataFrame, shards: int, min_chars: int, min_docs: int, unit_rows: int) -> DataFrame:
    """The digests of all documents go to the shards, block by block, and what is lost comes back."""
    lines = lines.withColumn("shard", F.pmod("a", F.lit(shards)).cast("bigint"))
    blocks = lines.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / unit_rows).cast("int").alias("blocks"))
    blocks = blocks.join(built.select("shard"), "shard", "left_semi")
    arrays = [c for c in built.columns if c != "shard"]
    kinds = {f.name: f.dataType for f in built.schema}
    spread = lines.join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("k", "a"), F.col("blocks")).cast("int"))
    copies = built.join(blocks, "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    both = copies.select("shard", "block", *arrays, *[F.lit(None).cast("bigint").alias(c) for c in ("k", "doc_id", "a", "b")]).unionByName(
        spread.select("shard", "block", *[F.lit(None).cast(kinds[c]).alias(c) for c in arrays], "k", "doc_id", "a", "b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            names = list(zip(*(batch[c].to_numpy() for c in ("shard", "block")), batch["bits"].is_valid().to_pylist()))
            cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            for first, last in zip(cuts, cuts[1:]):
                part = batch.slice(first, last - first)
                if last > first and names[first][2]:
                    shard = Shard.of(part.slice(0, 1).to_pylist()[0])
                elif last > first:
                    a, b = (part[c].to_numpy().view(np.uint64) for c in ("a", "b"))
                    yield part.select(["k", "doc_id", "a", "b"]).filter(pa.array(shard.lost(a, b, *ids_of(part["doc_id"]), min_docs)))

    dealt = both.repartition("shard", "block").sortWithinPartitions("shard", "block", F.col("bits").isNull())
    hits = dealt.mapInArrow(run, "k bigint, doc_id bigint, a bigint, b bigint")
    # One document's lines at most.
    lost = hits.groupBy("k", "doc_id").agg(F.collect_set(F.struct("a", "b")).alias("lost")).withColumnsRenamed({"k": "k2", "doc_id": "id2"})
    rows = docs.withColumn("k", row_key("doc_id", "text"))
    rows = rows.join(lost, (F.col("k") == F.col("k2")) & F.col("doc_id").eqNullSafe(F.col("id2")), "left").select("doc_id", "text", "lost")

    def lose(part: pa.RecordBatch, owners: np.ndarray, halves: np.ndarray) -> np.ndarray:
        lost = [{(d["a"], d["b"]) for d in some or ()} for some in part["lost"].to_pylist()]
        return np.array([pair in lost[i] for i, pair in zip(owners.tolist(), map(tuple, halves.view(np.int64).tolist()))], dtype=bool)

    return cut(rows, lose, min_chars)


def line_dedup(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, shard_keys: int = SHARD_KEYS, broadcast_bytes: int = BROADCAST_BYTES, unit_rows: int = UNIT_ROWS
) -> DataFrame:
    """One row per document: doc_id, n_lines before dropping, n_dropped, and the kept lines."""
    docs = prepared(docs)
    lines = stage(occurrences(docs, min_chars), "lines")
    found = stage(repeated(lines, min_docs), "repeated")
    shards = max(1, -(-found.count() // shard_keys))
    built = stage(index(found, shards), "shards")
    size = built.agg(F.sum(sum(F.length(c) for c in ("bits", "prints", "counts", "keepers")))).first()[0] or 0
    if size <= broadcast_bytes:
        return probed(docs, built, shards, min_chars, min_docs)
    return routed(docs, lines, built, shards, min_chars, min_docs, unit_rows)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup(read(spark, folder, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL = f"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM cut),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
marked AS (SELECT k.*, r.key IS NOT NULL AND keeper IS DISTINCT FROM doc_id AS gone FROM keyed k LEFT JOIN repeated r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
