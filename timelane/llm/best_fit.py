"""Packing of documents into fixed-length sequences by bounded-space online best fit.

A document becomes the ids of its text and an end id; only one longer than ``length`` is cut, into pieces of
``length``.  A packer holds at most ``open_bins`` open sequences.  Each piece goes into the open sequence with the least
free space that still takes it; a bit set with one bit per amount of free space finds it in one step.  Without such a
sequence a new one is opened, and if all are open, the fullest is closed first.

Full pieces are sequences of their own where they are.  All other pieces are dealt out by hash and place over packers, one per
``packer_rows`` of them, so a packer's unfilled rest is a small part of it; a packer keeps only its open bins, however
many pieces pass.  Pieces carry length and checksum only, never text.

Null texts count as empty, and empty texts are one piece (the end id).  A null doc_id is kept.  Repeated rows are packed
once per row.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from timelane.llm.common import read, slices, stage, utf8_column, worker_cache

VOCABULARY = "word_bpe_49k.json"
LENGTH, END_ID = 2048, 0
OPEN_BINS = 4096
PACKER_ROWS = 100_000
#: Words whose ids a task remembers.
MEMO_WORDS = 800_000
#: White space to Python but not to the vocabulary, which keeps it as marks.
CONTROLS = re.compile("[\x1c-\x1f]")
#: Letters without marks to compose or special lower case, then punctuation.
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([.,;:!?]*)")
#: Their lower-case forms that the model takes as they are: one piece each, whatever stands beside them.
LETTERS = re.compile("[a-zß-öø-įı-ɏ]+")


def tokenizer(path: str) -> Tokenizer:
    """Loaded once per worker."""
    name = f"words of {path}"
    if name not in worker_cache():
        found = Tokenizer.from_file(path)
        found.encode_special_tokens = True
        worker_cache()[name] = found
    return worker_cache()[name]


def letter_bytes(coder: Tokenizer) -> dict[int, str] | None:
    """What the vocabulary's model gets for each of ``LETTERS``; None where a run of them would be changed or cut before."""
    letters = [c for c in map(chr, range(0x250)) if LETTERS.fullmatch(c) and c == c.lower()]
    run = "".join(letters)
    if not (coder.normalizer and coder.pre_tokenizer) or coder.normalizer.normalize_str(run) != run or not all(t.special for t in coder.get_added_tokens_decoder().values()):
        return None
    table = {ord(c): "".join(piece for piece, _ in coder.pre_tokenizer.pre_tokenize_str(c)) for c in letters}
    whole = [piece for piece, _ in coder.pre_tokenizer.pre_tokenize_str(run)] == [run.translate(table)]
    return table if whole and all(table[ord(c)] == c for c in letters if c.isascii()) else None


class WordIds(dict):
    """Ids of words, little-endian 32-bit, each found when it is first asked for.

    A plain word with marks after it is looked up as letters, in lower case, and marks; letters go to the vocabulary's model
    alone, as there is nothing to normalise or to cut, any other word through the whole vocabulary.
    """

    def __init__(self, path: str):
        self.coder, name = tokenizer(path), f"letters of {path}"
        if name not in worker_cache():
            worker_cache()[name] = letter_bytes(self.coder)
        self.model, self.table = self.coder.model, worker_cache()[name]

    def __missing__(self, word: str) -> bytes:
        plain = PLAIN.fullmatch(word)
        stem, marks = (plain[1].lower(), plain[2]) if plain else (word, "")
        if marks or stem != word:
            found = self[stem] + self[marks] if marks else self[stem]
        else:
            if self.table and LETTERS.fullmatch(word):
                ids = [token.id for token in self.model.tokenize(word if word.isascii() else word.translate(self.table))]
            else:
                ids = self.coder.encode(word, add_special_tokens=False).ids
            found = struct.pack(f"<{len(ids)}I", *ids)
        self[word] = found
        return found


def word_ids(texts: list[str], path: str, memo: WordIds | None = None) -> Iterator[bytes]:
    """Ids of each text, little-endian 32-bit.  ``memo`` holds the ids of words met before.

    The vocabulary drops white space and never merges over it, so a text's ids are those of its words one by one; words
    repeat, so most are looked up.
    """
    memo = WordIds(path) if memo is None else memo
    for text in texts:
        yield b"".join(map(memo.__getitem__, text.split(" ") if CONTROLS.search(text) else text.split()))
        # Frequent words have come early; later ones are forgotten again.
        while len(memo) > MEMO_WORDS:
            memo.popitem()


def pieces(docs: DataFrame, path: str, length: int, end_id: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and end id, cut where longer than ``length``."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Gone with the task: idle workers stay for later stages, and one may hold hundreds of MB of words.
        memo = WordIds(path)
        for batch in batches:
            for first, last in slices(utf8_column(batch["text"])[1]):
                part = batch.slice(first, last - first)
                rows = []
                for doc_id, ids in zip(part["doc_id"].to_pylist(), word_ids(part["text"].to_pylist(), path, memo)):
                    ids += end
                    for i, start in enumerate(range(0, len(ids) // 4, length)):
                        piece = ids[4 * start : 4 * (start + length)]
                        rows.append((doc_id, i, start, len(piece) // 4, zlib.crc32(piece)))
                columns = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["doc_id", "piece", "start", "length", "ids_crc32"]
                )

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


class Packer:
    """Open sequences by free space: ``bits`` has a bit for every amount of which there is one."""

    def __init__(self, length: int, open_bins: int):
        self.length, self.open_bins = length, open_bins
        self.bins: list[list[int]] = [[] for _ in range(length + 1)]
        self.bits = self.count = self.opened = 0

    def take(self, free: int) -> int:
        bins = self.bins[free]
        name = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.count -= 1
        return name

    def place(self, size: int) -> tuple[int, int]:
        """Sequence and offset of a piece."""
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            name = self.take(free)
        else:
            if self.count >= self.open_bins:
                self.take((self.bits & -self.bits).bit_length() - 1)
            name, free = self.opened, self.length
            self.opened += 1
        rest = free - size
        if rest:
            self.bins[rest].append(name)
            self.bits |= 1 << rest
            self.count += 1
        return name, self.length - free


def best_fit(parts: DataFrame, length: int = LENGTH, open_bins: int = OPEN_BINS, packer_rows: int = PACKER_ROWS) -> DataFrame:
    """``parts`` (staged; any columns with ``length``) with sequence_id and offset."""
    small = F.col("length") < length
    packers = max(1, -(-parts.where(small).count() // packer_rows))
    schema = parts.select("*", F.lit(0).cast("bigint").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        base = (TaskContext.get().partitionId() + 1) << 40
        packer = Packer(length, open_bins)
        for batch in batches:
            placed = [packer.place(size) for size in batch["length"].tolist()]
            if placed:
                name, offset = zip(*placed)
                yield batch.assign(sequence_id=[base + n for n in name], offset=offset)

    # Equal rows have places of their own in the staged table, so they are dealt out like any others.
    numbered = parts.where(small).withColumn("__row", F.monotonically_increasing_id())
    dealt = numbered.repartition(packers, F.xxhash64("doc_id", "piece", "ids_crc32", "__row")).drop("__row")
    packed = dealt.sortWithinPartitions(F.xxhash64("ids_crc32", "doc_id", "piece")).mapInPandas(run, schema)
    # Full pieces: negative numbers, so they never meet a packer's.
    full = parts.where(~small).select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return packed.unionByName(full)


def pack(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH, end_id: int = END_ID, open_bins: int = OPEN_BINS, packer_rows: int = PACKER_ROWS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    return best_fit(stage(pieces(docs, path, length, end_id), "pieces"), length, open_bins, packer_rows)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return pack(read(spark, folder, "documents"))
