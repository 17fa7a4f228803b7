"""Removal of repeated word passages with prefix-partitioned suffix trees.

Every window of ``window`` consecutive words is the head of one suffix of its document.  A word goes if a window over it
also occurs in a document with a smaller doc_id; windows are judged on the input, not on what is left.

1. Suffixes are split by prefixes.  Each window names its split point by content alone: the ``prefix`` neighbouring
   words inside it with the smallest hash (leftmost of equals), so equal windows of different documents always name the
   same prefix.  Neighbouring windows with one prefix are a place; its words have a digest, and equal places are one
   class: all but those of the smallest doc_id are repeats as they are, whatever their number, and no text of them is
   read.  Prefixes whose classes all start in one document hold no other repeat and end here.
2. Where a prefix has at most ``group_rows`` places, their texts are one memory-sized group: a task sorts the group's
   suffixes, which with the common length of neighbours is the suffix tree; internal nodes at least ``window`` deep are
   the repeats, and the smallest doc_id below a node decides.
3. A more frequent prefix is made longer, up to the whole window.  Suffixes with the same whole window are one node;
   only the smallest doc_id is needed of it, and that is combined before the shuffle.  The nodes with several documents
   then meet the places of their prefix, which are dealt out in blocks of ``block_rows``; no task gathers a hot prefix.

Exact copies (equal word sequences) are one class before all this: any later copy of at least ``window`` words is
removed whole.  Rows with a null doc_id neither remove nor lose words, a null text has none, repeated rows (same
doc_id and text) get equal results, and rows with one doc_id never remove words of each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from timelane.functions.sides import beside
from timelane.llm.common import mix, ngram_hash, read, row_key, slices, stage, utf8_column, word_table

WINDOW, PREFIX = 50, 8
GROUP_ROWS = 512
#: Suffixes that a task sorts at a time, if one group does not hold more.
TREE_ROWS = 20_000
#: Places of a hot prefix, and nodes of it, that a task holds at a time.
BLOCK_ROWS, BLOCK_NODES = 4096, 50_000

#: Rows of one key that may meet in one task of a join.
JOIN_ROWS = 4096

SUMMARY = "doc_id bigint, k bigint, n_words bigint, words_id binary, sha string, parts array<struct<h:bigint,s:int,e:int,c:binary>>"


def split_points(h: np.ndarray, window: int, prefix: int) -> np.ndarray:
    """For every window of the words ``h`` the place of the prefix it names."""
    low = ngram_hash(h, prefix)
    width, at = window - prefix + 1, np.arange(len(low))
    done = 1
    while done < width:
        step = min(done, width - done)
        later, earlier = low[step:], low[:-step]
        take = later < earlier
        low, at = np.where(take, later, earlier), np.where(take, at[step:], at[:-step])
        done += step
    return at


def joined_words(b: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    """The words joined by one space."""
    if len(start) == 0:
        return b""
    lengths = end - start + 1
    first = np.cumsum(lengths) - lengths
    index = np.arange(int(lengths.sum())) - np.repeat(first - start, lengths)
    gap = first + lengths - 1
    index[gap] = 0
    out = b[index]
    out[gap] = 32
    return out[:-1].tobytes()


def summaries(docs: DataFrame, window: int, prefix: int) -> DataFrame:
    """Per row its word count, word identity, hash of the joined words, and its runs of windows by named prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = utf8_column(batch["text"])
            for first, last in slices(bounds):
                t = word_table(data, bounds, first, last)
                counts, ids, shas, runs, sizes, places = [], [], [], [], [], []
                for a, b in zip(t.rows[:-1], t.rows[1:]):
                    text = joined_words(t.data, t.start[a:b], t.end[a:b])
                    counts.append(b - a)
                    ids.append(xxhash.xxh3_128_digest(text))
                    shas.append(hashlib.sha256(text).hexdigest())
                    if b - a < window:
                        sizes.append(0)
                        continue
                    h = t.hash[a:b]
                    at = split_points(h, window, prefix)
                    begin = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                    end = np.append(begin[1:], len(at))
                    runs.append((ngram_hash(h, prefix)[at[begin]].view(np.int64), begin, end))
                    sizes.append(len(begin))
                    stops = np.cumsum(t.end[a:b] - t.start[a:b] + 1)
                    starts = stops - (t.end[a:b] - t.start[a:b] + 1)
                    places += [xxhash.xxh3_128_digest(text[x:y]) for x, y in zip(starts[begin].tolist(), (stops[end + window - 2] - 1).tolist())]
                h, s, e = (np.concatenate([r[i] for r in runs]) if runs else np.zeros(0, np.int64) for i in range(3))
                parts = pa.StructArray.from_arrays([pa.array(h, pa.int64()), pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(places, pa.binary())], names=["h", "s", "e", "c"])
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["k"], pa.array(counts, pa.int64()), pa.array(ids, pa.binary()), pa.array(shas),
                     pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), parts)],
                    names=["doc_id", "k", "n_words", "words_id", "sha", "parts"],
                )

    return keyed(docs).mapInArrow(run, SUMMARY)


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), row_key("doc_id", "text").alias("k"))


def sized_join(rows: DataFrame, facts: DataFrame, keys: list[str], most: int = JOIN_ROWS) -> DataFrame:
    """``rows`` with the ``facts`` of their keys, null where there are none; ``facts`` also counts the rows ``n`` of a key.

    The facts of keys with more than ``most`` rows travel to the rows, if they are measured to be small.  Rows that have
    theirs go through the other join under a key of their own, so none of its tasks meets a frequent key.
    """
    rest = [c for c in facts.columns if c not in (*keys, "n")]
    frequent = beside(facts.where(F.col("n") > most).select(*keys, F.struct(*rest).alias("__often")))
    others = facts.where(F.col("n") <= most).select(*[F.col(c).alias(f"__{c}") for c in keys], F.struct(*rest).alias("__seldom"))
    first = rows.join(frequent, keys, "left")
    lead = F.when(F.col("__often").isNull(), F.col(keys[0])).otherwise(F.xxhash64("k", "s")).alias("__lead")
    same = (F.col("__lead") == F.col(f"__{keys[0]}"))
    for c in keys[1:]:
        same = same & (F.col(c) == F.col(f"__{c}"))
    met = first.select("*", lead).join(others, same, "left").withColumn("__fact", F.coalesce("__often", "__seldom"))
    return met.select(*rows.columns, *[F.col("__fact")[c].alias(c) for c in rest])


def suffix_tree(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order and the depth of the node that joins each suffix with the one before it (0 for the first)."""
    keys = np.ascontiguousarray(rows.byteswap()).view(np.dtype((np.void, rows.shape[1] * 8))).ravel()
    order = np.argsort(keys, kind="stable")
    ranked = rows[order]
    differs = ranked[1:] != ranked[:-1]
    depth = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    return order, np.append(0, depth)


def deep_nodes(rows: np.ndarray, owner: np.ndarray, window: int) -> np.ndarray:
    """For every suffix the smallest owner below its node of depth ``window``."""
    order, depth = suffix_tree(rows)
    heads = np.flatnonzero(depth < window)
    least = np.minimum.reduceat(owner[order], heads)
    out = np.empty(len(owner), dtype=owner.dtype)
    out[order] = np.repeat(least, np.diff(np.append(heads, len(order))))
    return out


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return edges[::2], edges[1::2]


def tree_repeats(places: DataFrame, window: int, tree_rows: int) -> DataFrame:
    """(k, s, e): runs of window starts that repeat one of a smaller doc_id, by suffix trees of whole prefix groups."""

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        _, docs, keys, starts, texts = zip(*rows)
        data, bounds = utf8_column(pa.array(texts, pa.string()))
        t = word_table(data, bounds, 0, len(texts))
        counts = np.diff(t.rows) - window + 1
        base = np.repeat(t.rows[:-1], counts)
        place = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        matrix = t.hash[(base + place)[:, None] + np.arange(window)]
        owner = np.repeat(np.array(docs, dtype=np.int64), counts)
        hit = deep_nodes(matrix, owner, window) < owner
        at, out = 0, []
        for k, s, n in zip(keys, starts, counts):
            for x, y in zip(*runs_of(hit[at : at + n])):
                out.append((k, s + int(x), s + int(y)))
            at += n
        if out:
            k, s, e = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(s, pa.int32()), pa.array(e, pa.int32())], names=["k", "s", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sealed, suffixes = [], 0, 0
        for batch in batches:
            for row in zip(*[batch[c].to_pylist() for c in ("h", "doc_id", "k", "s", "context", "n")]):
                if held and row[0] != held[-1][0]:
                    sealed = len(held)
                    if suffixes >= tree_rows:
                        yield from solve(held[:sealed])
                        held, sealed, suffixes = [], 0, 0
                held.append(row[:5])
                suffixes += row[5]
        if held:
            yield from solve(held)

    dealt = places.select("h", "doc_id", "k", "s", "context", "n").repartition("h").sortWithinPartitions("h")
    return dealt.mapInArrow(run, "k bigint, s int, e int")


def contexts(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(h, doc_id, k, s, context, n, hot): text of the wanted places, each a run of n windows from word s on.

    ``wanted`` holds (k, p): the row's runs as (h, s, e, hot).
    """
    names = ["h", "doc_id", "k", "s", "context", "n", "hot"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, parts = batch["doc_id"].to_pylist(), batch["k"].to_pylist(), batch["p"].to_pylist()
            data, bounds = utf8_column(batch["text"])
            for first, last in slices(bounds):
                t = word_table(data, bounds, first, last)
                rows = []
                for i in range(first, last):
                    a = t.rows[i - first]
                    for p in parts[i]:
                        x, y = a + p["s"], a + p["e"] + window - 1
                        rows.append((p["h"], ids[i], keys[i], p["s"], joined_words(t.data, t.start[x:y], t.end[x:y]).decode(), p["e"] - p["s"], p["hot"]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(zip(*rows), types)], names=names)

    met = docs.join(wanted, "k").groupBy("k").agg(F.any_value("doc_id").alias("doc_id"), F.any_value("text").alias("text"), F.any_value("p").alias("p"))
    return met.mapInArrow(run, "h bigint, doc_id bigint, k bigint, s int, context string, n int, hot boolean")


def window_nodes(context: str, window: int) -> list[bytes]:
    """128-bit digests that name the nodes of a context's windows."""
    words = context.encode().split(b" ")
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.append(0, ends[:-1])
    data = context.encode()
    return [xxhash.xxh3_128_digest(data[starts[i] : ends[i + window - 1] - 1]) for i in range(len(words) - window + 1)]


def grown_repeats(places: DataFrame, window: int, block_rows: int, block_nodes: int) -> DataFrame:
    """(k, s, e) as ``tree_repeats``, for hot prefixes."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Combined in the task: a node that many places share is one row.
            found: dict[tuple[int, bytes], list[int]] = {}
            for h, doc, context in zip(batch["h"].to_pylist(), batch["doc_id"].to_pylist(), batch["context"].to_pylist()):
                for node in window_nodes(context, window):
                    span = found.setdefault((h, node), [doc, doc])
                    span[0], span[1] = min(span[0], doc), max(span[1], doc)
            if found:
                h, nodes = zip(*found)
                lo, hi = zip(*found.values())
                yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(nodes, pa.binary()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], names=["h", "node", "lo", "hi"])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, least = None, {}
        for batch in batches:
            out = []
            for h, part, salt, parts, node, doc, k, s, context in zip(*[batch[c].to_pylist() for c in columns]):
                if (h, part, salt) != name:
                    name, least = (h, part, salt), {}
                if node is not None:
                    least[node] = doc
                    continue
                hit = np.array([least.get(n, doc) < doc for n in window_nodes(context, window)])
                out += [(k, s + int(x), s + int(y)) for x, y in zip(*runs_of(hit))]
            if out:
                k, s, e = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(s, pa.int32()), pa.array(e, pa.int32())], names=["k", "s", "e"])

    # Places of a hot prefix are spread over all tasks.
    places = stage(places.repartition(F.xxhash64("k", "s")), "hot")
    nodes = places.mapInArrow(grow, "h bigint, node binary, lo bigint, hi bigint").groupBy("h", "node").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    nodes = stage(nodes.where("lo <> hi").select("h", "node", "lo"), "nodes")
    sizes = nodes.groupBy("h").agg(F.ceil(F.count(F.lit(1)) / block_nodes).cast("int").alias("parts"))
    sizes = sizes.join(places.groupBy("h").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("salts")), "h")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["h", "part", "salt", "parts", "node", "doc_id", "k", "s", "context"]
    named = nodes.join(sizes, "h").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).withColumn("salt", every("salts"))
    named = named.select("h", "part", "salt", "parts", "node", F.col("lo").alias("doc_id"), F.lit(None).cast("bigint").alias("k"), F.lit(None).cast("int").alias("s"), F.lit(None).cast("string").alias("context"))
    placed = places.join(sizes, "h").withColumn("salt", F.pmod(F.xxhash64("k", "s"), F.col("salts")).cast("int")).withColumn("part", every("parts"))
    placed = placed.withColumn("node", F.lit(None).cast("binary")).select(*columns)
    # Nodes come before places.
    dealt = named.unionByName(placed).repartition("h", "part", "salt").sortWithinPartitions("h", "part", "salt", F.col("node").isNull())
    return dealt.mapInArrow(match, "k bigint, s int, e int")


def without_repeats(docs: DataFrame, repeats: DataFrame, window: int, keep_text: bool) -> DataFrame:
    """(k, n_removed, kept_sha256, kept) of the rows that lose words; ``kept`` is the text left over.

    ``kept`` keeps the white space around kept words, so a pipeline goes on with text; the hash is of the words alone.
    """
    merged = repeats.groupBy("k").agg(F.collect_set(F.struct("s", "e")).alias("r"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranges, keys = batch["r"].to_pylist(), batch["k"]
            data, bounds = utf8_column(batch["text"])
            for first, last in slices(bounds):
                t = word_table(data, bounds, first, last)
                removed, shas, texts = [], [], []
                for i in range(first, last):
                    a, b = t.rows[i - first], t.rows[i - first + 1]
                    change = np.zeros(b - a + 1, dtype=np.int64)
                    for r in ranges[i]:
                        change[r["s"]] += 1
                        change[r["e"] + window - 1] -= 1
                    keep = np.cumsum(change)[:-1] == 0
                    start, end = t.start[a:b], t.end[a:b]
                    removed.append(int((~keep).sum()))
                    shas.append(hashlib.sha256(joined_words(t.data, start[keep], end[keep])).hexdigest())
                    stop = np.append(start[1:], bounds[i + 1] - bounds[first])
                    texts.append(b"".join(t.data[start[x] : stop[y - 1]].tobytes() for x, y in zip(*runs_of(keep))).decode() if keep_text else None)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(first, last - first), pa.array(removed, pa.int64()), pa.array(shas), pa.array(texts, pa.string())], names=["k", "n_removed", "kept_sha256", "kept"]
                )

    # Repeated rows are met once: their key is the same.
    met = docs.join(merged, "k").groupBy("k").agg(F.any_value("text").alias("text"), F.any_value("r").alias("r"))
    return met.mapInArrow(run, "k bigint, n_removed bigint, kept_sha256 string, kept string")


def substring_dedup(
    docs: DataFrame,
    window: int = WINDOW,
    prefix: int = PREFIX,
    group_rows: int = GROUP_ROWS,
    tree_rows: int = TREE_ROWS,
    block_rows: int = BLOCK_ROWS,
    block_nodes: int = BLOCK_NODES,
    keep_text: bool = True,
) -> DataFrame:
    """One row per document: doc_id, k, n_words, n_removed, kept_sha256, and kept (text left; null if nothing went).

    ``prefix`` must be at most ``window``; ``group_rows`` bounds a group and ``tree_rows`` what a task sorts at a time.
    """
    source = keyed(docs)
    summary = stage(summaries(docs, window, prefix), "words")
    named = summary.where("doc_id IS NOT NULL")
    firsts = named.where(F.col("n_words") >= window).groupBy("words_id").agg(F.min("doc_id").alias("first_id"))
    judged = named.join(firsts, "words_id")
    heads = judged.where("doc_id = first_id").groupBy("k").agg(F.any_value("doc_id").alias("doc_id"), F.any_value("parts").alias("parts"))
    places = stage(heads.select("k", "doc_id", F.explode("parts").alias("p")).select("k", "doc_id", "p.h", "p.s", "p.e", "p.c"), "places")

    classes = places.groupBy("h", "c").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n"))
    copied = stage(classes.where("lo <> hi").drop("hi"), "copied")
    judged = stage(sized_join(places, copied, ["h", "c"]).withColumn("repeats", F.coalesce(F.col("doc_id") > F.col("lo"), F.lit(False))).drop("lo", "c"), "judged")
    copies = judged.where("repeats").select("k", "s", "e")
    first = judged.where("NOT repeats")
    shared = first.groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo <> hi")
    shared = stage(shared.select("h", "n", (F.col("n") > group_rows).alias("hot")), "shared")
    met = sized_join(first, shared, ["h"]).where("hot IS NOT NULL")
    wanted = met.groupBy("k").agg(F.collect_list(F.struct("h", "s", "e", "hot")).alias("p"))
    split = stage(contexts(source, wanted, window), "contexts")

    trees = tree_repeats(split.where("NOT hot"), window, tree_rows)
    grown = grown_repeats(split.where("hot").drop("hot", "n"), window, block_rows, block_nodes)
    lost = without_repeats(source, trees.unionByName(grown).unionByName(copies), window, keep_text)

    out = summary.join(firsts, "words_id", "left").join(lost, "k", "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    return out.select(
        "doc_id",
        "k",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("bigint"))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    found = substring_dedup(read(spark, folder, "documents"), keep_text=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)),
firsts AS (SELECT t, min(doc_id) AS lo FROM windows GROUP BY t HAVING min(doc_id) <> max(doc_id)),
hits AS (SELECT w.doc_id, list(w.i) AS s FROM windows w JOIN firsts f ON w.t = f.t WHERE w.doc_id > f.lo GROUP BY w.doc_id),
gone AS (SELECT doc_id, list_distinct(flatten([range(x, x + 50) FOR x IN s])) AS g FROM hits),
marked AS (SELECT w.doc_id, w.w, list_sort(coalesce(g.g, [])) AS g FROM words w LEFT JOIN gone g USING (doc_id)),
singles AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words) u
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id, unnest(g) AS j FROM gone) x WHERE x.doc_id = u.doc_id AND x.j = u.i)
  GROUP BY doc_id)
SELECT m.doc_id, CAST(len(m.w) AS BIGINT) AS n_words, CAST(len(m.g) AS BIGINT) AS n_removed, sha256(coalesce(s.kept, '')) AS kept_sha256
FROM marked m LEFT JOIN singles s USING (doc_id)
"""
