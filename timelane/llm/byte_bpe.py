"""Byte-level BPE by overlapping chunks: pre-tokenize in parallel, stitch at common boundaries, encode, decode.

A text longer than ``chunk`` characters becomes overlapping chunks, each pre-tokenized on its own from its first
character.  Since the split of a text from a boundary on depends only on what follows, two neighbouring chunks agree
for good from the first boundary that both have.  That is where they are stitched; every piece between two stitches is
encoded by itself, and the ids of a text are those of its pieces in order.  Boundaries within ``margin`` characters of a
chunk's end are not trusted, as the text after it could change them.  Where two chunks share no boundary (one long run
without a break) the right one is joined to the left one, and the joined stretch is split again.

Shorter texts are one piece and need no shuffle.  Null texts count as empty.  Repeated rows, null doc_ids and extra
columns are kept apart by a row number, so every input row gives one row.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from timelane.llm.common import read, worker_cache

RANKS = "byte_bpe_50k.tiktoken"
CHUNK, OVERLAP, MARGIN = 32_768, 512, 32


def encoding(path: str) -> tiktoken.Encoding:
    """The encoding of a file of ranks, loaded once per worker."""
    name = f"ranks of {path}"
    if name not in worker_cache():
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        worker_cache()[name] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return worker_cache()[name]


def splitter() -> regex.Pattern:
    # Compiled once: the module keeps patterns it has met.
    return regex.compile(public_tokenizers.PATTERN)


def ids_bytes(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def boundaries(text: str) -> list[int]:
    """Starts of all pre-tokens; they leave no gap."""
    return [m.start() for m in splitter().finditer(text)]


def digests(ids: bytes, coder: tiktoken.Encoding) -> tuple[int, str, str]:
    numbers = np.frombuffer(ids, dtype="<u4").tolist()
    return len(numbers), hashlib.sha256(ids).hexdigest(), hashlib.sha256(coder.decode_bytes(numbers)).hexdigest()


def chunks(docs: DataFrame, chunk: int, overlap: int, margin: int) -> DataFrame:
    """(row, doc_id, i, at, size, text, head, tail): chunk i starts at ``at``; head and tail are trusted boundaries
    inside the overlap with the chunk before and after it, as places in the whole text."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, doc_id, text in zip(batch["row"], batch["doc_id"], batch["text"]):
                for i, at in enumerate(range(0, len(text), chunk)):
                    yield pd.DataFrame({"row": [row], "doc_id": pd.array([doc_id], "Int64"), "i": [i], "at": [at], "size": [len(text)], "text": [text[at : at + chunk + overlap]]})

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            heads, tails = [], []
            for at, size, text in zip(batch["at"], batch["size"], batch["text"]):
                places = [at + p for p in boundaries(text) if at + len(text) == size or p < len(text) - margin]
                heads.append([p for p in places if at <= p < at + overlap])
                tails.append([p for p in places if p >= at + chunk])
            yield batch.assign(head=heads, tail=tails)

    schema = "row bigint, doc_id bigint, i int, at bigint, size bigint, text string"
    rows = docs.mapInPandas(cut, schema).repartition(F.col("row"), F.col("i"))
    return rows.mapInPandas(split, f"{schema}, head array<bigint>, tail array<bigint>")


def stitched(parts: DataFrame, chunk: int) -> DataFrame:
    """(row, doc_id, i, text): the pieces between stitches.  A chunk without a stitch joins the piece before it."""
    order = Window.partitionBy("row").orderBy("i")
    meet = F.array_min(F.array_intersect("head", F.lag("tail").over(order)))
    parts = parts.withColumn("cut", F.when(F.col("i") == 0, F.lit(0)).otherwise(meet))
    parts = parts.withColumn("piece", F.count("cut").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    # Without a stitch the texts are joined at the chunk bounds; where there is one the piece starts there.
    next_cut = F.lead("cut").over(order)
    start = F.coalesce("cut", "at") - F.col("at")
    stop = F.when(F.lead("i").over(order).isNull(), F.col("size")).otherwise(F.coalesce(next_cut, F.lead("at").over(order))) - F.col("at")
    cut = parts.withColumn("start", start).withColumn("stop", stop)
    text = F.substring("text", F.col("start") + 1, F.col("stop") - F.col("start"))
    return cut.select("row", "doc_id", "i", "piece", text.alias("text"))


def encode(docs: DataFrame, ranks: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP, margin: int = MARGIN) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) of every row; ids are little-endian 32-bit numbers."""
    path = ranks or public_tokenizers.path(RANKS)
    schema = "doc_id bigint, n_tokens bigint, ids binary, ids_sha256 string, decoded_sha256 string"
    source = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(path)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                ids = ids_bytes(coder.encode_ordinary(text.as_py()))
                rows.append((ids, *digests(ids, coder)))
            if rows:
                ids, n, a, b = zip(*rows)
                yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(a), pa.array(b)], names=["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"])

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = encoding(path)
        for batch in batches:
            ids = [ids_bytes(coder.encode_ordinary(t)) for t in batch["text"]]
            yield batch[["row", "doc_id", "piece"]].assign(ids=ids)

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        # One group is one text.
        ids = b"".join(group.sort_values("piece")["ids"])
        n, a, b = digests(ids, encoding(path))
        return pd.DataFrame({"doc_id": pd.array(group["doc_id"].iloc[:1], "Int64"), "n_tokens": [n], "ids": [ids], "ids_sha256": [a], "decoded_sha256": [b]})

    short = source.where(F.length("text") <= chunk).drop("row").mapInArrow(whole, schema)
    parts = stitched(chunks(source.where(F.length("text") > chunk), chunk, overlap, margin), chunk)
    joined = parts.groupBy("row", "doc_id", "piece").agg(F.array_join(F.sort_array(F.collect_list(F.struct("i", "text")))["text"], "").alias("text"))
    coded = joined.repartition("row", "piece").mapInPandas(pieces, "row bigint, doc_id bigint, piece bigint, ids binary")
    long = coded.groupBy("row").applyInPandas(gather, schema)
    return short.unionByName(long)


def decode(coded: DataFrame, ranks: str | None = None) -> DataFrame:
    """(doc_id, data): the bytes of ``ids``, joined without any repair."""
    path = ranks or public_tokenizers.path(RANKS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = encoding(path)
        for batch in batches:
            data = [coder.decode_bytes(np.frombuffer(i, dtype="<u4").tolist()) for i in batch["ids"]]
            yield batch[["doc_id"]].assign(data=data)

    return coded.select("doc_id", "ids").mapInPandas(run, "doc_id bigint, data binary")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return encode(read(spark, folder, "documents")).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
