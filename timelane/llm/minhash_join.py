"""MinHash near-duplicates by an inverted join on signature coordinates.

A document's shingle set gives ``coordinates`` values; a coordinate's value is the minima of two hash functions, and
coordinate and value together are a token.  Two sets of similarity s agree in a coordinate with probability s * s, so
unlike texts hardly ever meet; a pair is a candidate if it agrees in at least ``matches`` coordinates.  At the
threshold of 0.8 a pair misses that with probability 1e-6.  Tokens of every signature are ordered from rare to frequent; a pair with that many
agreements must share one of the first ``coordinates - matches + 1`` tokens of both signatures, so only this prefix
is posted.  Candidates are confirmed on the full sets.

Equal sets become one class first.  Then links are found in two steps, so that a large group of near copies is not
expanded into all its pairs: (1) every member of a posting is compared with a few fixed members of it, and what links
falls into components; (2) the postings that still hold more than one component are merged in blocks: all their pairs
across components are counted, each pair in its first common token only, and those with enough agreements are compared
in the task, of which only a spanning forest leaves it.  A link between two components is therefore never lost to step
1, and links inside one change nothing.

Rows with a null doc_id or no words link with nothing (their component is their own doc_id).  Repeated rows get equal
results.  Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from timelane.llm.common import MIX_A, edge_components, mix, read, row_key, slices, stage, utf8_column, word_table

COORDINATES, MATCHES = 32, 8
LEADERS = 2
#: Rows of a posting that one block holds.
BLOCK_ROWS = 2048
#: Shingles hashed under all seeds at a time.
STRETCH = 2048

SIGNATURE = "doc_id bigint, k bigint, n_shingles bigint, set_id binary, tokens array<bigint>"


def shingle_sets(data, bounds, first: int, last: int, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row; a shorter text is one shingle, an empty one has none."""
    table = word_table(data, bounds, first, last, lower=True)
    weights = [mix(np.array([j + 1], dtype=np.uint64))[0] | np.uint64(1) for j in range(words)]
    for a, b in zip(table.rows[:-1], table.rows[1:]):
        h = table.hash[a:b]
        n = min(words, len(h))
        if n == 0:
            yield h
            continue
        total = np.zeros(len(h) - n + 1, dtype=np.uint64)
        for j in range(n):
            total += h[j : len(h) - n + 1 + j] * weights[j]
        # A shorter text never equals a part of a longer one.
        yield np.unique(mix(total + np.uint64(n)))


def minima(s: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Per seed the minima of both halves of the hashes (each half is a hash function of its own), as one number.

    All seeds at once, over ``STRETCH`` shingles at a time, so a long text needs no more memory.
    """
    found = np.full((len(seeds), 2), np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(s), STRETCH):
        halves = mix(s[None, at : at + STRETCH] ^ seeds[:, None]).view(np.uint32)
        for i in range(2):
            np.minimum(found[:, i], halves[:, i::2].min(axis=1), out=found[:, i])
    return found.view(np.uint64).ravel()


def signatures(docs: DataFrame, words: int, coordinates: int = COORDINATES) -> DataFrame:
    """Set size, set identity and tokens of every document."""
    seeds = mix(np.arange(1, coordinates + 1, dtype=np.uint64) * MIX_A)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = utf8_column(batch["text"])
            for first, last in slices(bounds):
                sizes, ids, tokens = [], [], []
                for s in shingle_sets(data, bounds, first, last, words):
                    sizes.append(len(s))
                    ids.append(xxhash.xxh3_128_digest(s.tobytes()))
                    # The coordinate is part of the token, so tokens of different coordinates never meet.
                    own = seeds if len(s) else seeds[:0]
                    tokens.append((minima(s, own) ^ own).view(np.int64))
                flat = pa.array(np.concatenate(tokens))
                offsets = pa.array(np.append(0, np.cumsum([len(t) for t in tokens])), pa.int32())
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["k"], pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.ListArray.from_arrays(offsets, flat)],
                    names=["doc_id", "k", "n_shingles", "set_id", "tokens"],
                )

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", row_key("doc_id", "text").alias("k"))
    return source.mapInArrow(run, SIGNATURE)


def prefixes(reps: DataFrame, matches: int, coordinates: int) -> DataFrame:
    """(rep, prefix): the tokens among the rarest of each signature that another document has as well."""
    tokens = reps.select("rep", F.explode("tokens").alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    room = coordinates - matches + 1
    # Tokens of one document only are the rarest; they fill the prefix first and need no posting.
    ranked = tokens.join(shared, "token").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("t"))
    left = F.greatest(F.lit(0), F.lit(room - coordinates) + F.size("t"))
    return ranked.select("rep", F.slice(F.col("t.token"), F.lit(1), left).alias("prefix")).where(F.size("prefix") > 0)


def leader_pairs(postings: DataFrame) -> DataFrame:
    """Every member of a posting with a few members that a hash picks from it."""
    order = [F.xxhash64("rep", F.lit(j)) for j in range(LEADERS)]
    picked = postings.groupBy("token").agg(*[F.min_by("rep", o).alias(f"l{j}") for j, o in enumerate(order)], F.count(F.lit(1)).alias("n")).where("n > 1")
    leaders = picked.select("token", F.explode(F.array_distinct(F.array(*[f"l{j}" for j in range(LEADERS)]))).alias("leader"))
    pairs = postings.select("token", "rep").join(leaders, "token").where("rep <> leader")
    return pairs.select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")).distinct()


def block_pairs(rows: DataFrame, key: str, sizes: DataFrame, block: int, salt) -> DataFrame:
    """Each row once per pair of blocks that its block is part of; (key, x, y) names the pair, ``block`` the row's own.

    ``sizes`` holds (key, n).  A key of n rows has ceil(n / block) blocks, so no pair of blocks exceeds two of them.
    """
    spread = rows.join(sizes.select(key, F.ceil(F.col("n") / block).cast("int").alias("blocks")), key)
    spread = spread.withColumn("block", F.pmod(salt, F.col("blocks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    spread = spread.withColumn("other", F.explode(others))
    return spread.select("*", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y")).drop("blocks", "other")


UNIT = ["token", "x", "y"]


def by_unit(rows: DataFrame, columns: list[str], solve, schema: str) -> DataFrame:
    """``solve(name, lists of columns)`` for every unit of work; it yields record batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, name = [], None
        for batch in batches:
            for token, x, y, *rest in zip(*[batch[c].to_pylist() for c in [*UNIT, *columns]]):
                if (token, x, y) != name:
                    if len(held) > 1:
                        yield from solve(name, *zip(*held))
                    held, name = [], (token, x, y)
                held.append(rest)
        if len(held) > 1:
            yield from solve(name, *zip(*held))

    return rows.select(*UNIT, *columns).repartition(*UNIT).sortWithinPartitions(*UNIT).mapInArrow(run, schema)


class Unit:
    """Candidates of one pair of blocks: different components, enough agreements, and the pair's first common token."""

    def __init__(self, name, component, block, prefix, tokens, matches: int):
        self.token, x, y = name
        self.component, block = np.array(component), np.array(block)
        self.signature, self.matches = np.array(tokens, dtype=np.int64), matches
        self.posted = np.array([np.isin(t, p) for t, p in zip(self.signature, prefix)])
        self.left = np.flatnonzero(block == x)
        self.right = None if x == y else np.flatnonzero(block == y)

    def partners(self, i: int) -> np.ndarray:
        js = self.left[self.left > i] if self.right is None else self.right
        js = js[self.component[js] != self.component[i]]
        equal = self.signature[js] == self.signature[i]
        js, equal = js[(n := equal.sum(axis=1)) >= self.matches], equal[n >= self.matches]
        shared = equal & self.posted[js] & self.posted[i]
        first = np.where(shared, self.signature[i], np.iinfo(np.int64).max).min(axis=1)
        return js[first == self.token]


def residual_links(postings: DataFrame, labels: DataFrame, tokens: DataFrame, sets_of, matches: int, percent: int) -> DataFrame:
    """Links between different components, from the postings that hold more than one.

    The signatures tell which members have a partner at all; only their sets are fetched, and compared in the task.  It
    skips pairs that its earlier links have joined, so what leaves it is a forest.
    """
    labelled = postings.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = stage(labelled.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo <> hi"), "mixed")
    spread = block_pairs(labelled, "token", mixed, BLOCK_ROWS, F.xxhash64("rep")).join(tokens, "rep")

    def promising(name, rep, component, block, prefix, tokens) -> Iterator[pa.RecordBatch]:
        unit = Unit(name, component, block, prefix, tokens, matches)
        hit = np.zeros(len(rep), dtype=bool)
        for i in unit.left:
            js = unit.partners(i)
            hit[js] = True
            hit[i] |= len(js) > 0
        at = np.flatnonzero(hit).tolist()
        if at:
            columns = [[v] * len(at) for v in name] + [[c[i] for i in at] for c in (rep, component, block, prefix, tokens)]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[*UNIT, "rep", "component", "block", "prefix", "tokens"])

    def linked(name, rep, component, block, prefix, tokens, shingles) -> Iterator[pa.RecordBatch]:
        unit = Unit(name, component, block, prefix, tokens, matches)
        sets = [np.array(s, dtype=np.int64) for s in shingles]
        found = []
        for i in unit.left:
            for j in unit.partners(i):
                if unit.component[i] == unit.component[j]:
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    found.append((rep[i], rep[j]))
                    unit.component[unit.component == unit.component[j]] = unit.component[i]
        if found:
            a, b = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    columns = ["rep", "component", "block", "prefix", "tokens"]
    schema = "token bigint, x int, y int, rep bigint, component bigint, block int, prefix array<bigint>, tokens array<bigint>"
    hopeful = stage(by_unit(spread, columns, promising, schema), "promising")
    sets = sets_of(hopeful.select("rep").distinct())
    return by_unit(hopeful.join(sets, "rep"), [*columns, "shingles"], linked, "a bigint, b bigint")


def shingles_of(needed: DataFrame, docs: DataFrame, reps: DataFrame, words: int) -> DataFrame:
    """(rep, shingles): the full sets of the documents ``needed`` (rep).  Only their texts are read into sets."""
    source = docs.select("text", row_key("doc_id", "text").alias("k"))
    # Repeated rows give one set; the join has already brought them together.
    texts = source.join(needed.join(reps.select("rep", "k"), "rep"), "k").groupBy("k", "rep").agg(F.any_value("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = utf8_column(batch["text"])
            for first, last in slices(bounds):
                for i, s in zip(range(first, last), shingle_sets(data, bounds, first, last, words)):
                    yield pa.RecordBatch.from_arrays(
                        [batch["rep"].slice(i, 1), pa.ListArray.from_arrays(pa.array([0, len(s)], pa.int32()), pa.array(s.view(np.int64)))], names=["rep", "shingles"]
                    )

    return stage(texts.select("rep", "text").mapInArrow(run, "rep bigint, shingles array<bigint>"), "shingles")


def confirmed(pairs: DataFrame, sets_of, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    pairs = stage(pairs, "pairs")
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct())
    one = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(one, "a").join(two, "b").where(100 * both >= percent * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def agreeing(pairs: DataFrame, tokens: DataFrame, matches: int) -> DataFrame:
    one = tokens.select(F.col("rep").alias("a"), F.col("tokens").alias("ta"))
    two = tokens.select(F.col("rep").alias("b"), F.col("tokens").alias("tb"))
    met = pairs.join(one, "a").join(two, "b")
    return met.where(F.size(F.array_intersect("ta", "tb")) >= matches).select("a", "b")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, coordinates: int = COORDINATES, matches: int = MATCHES
) -> DataFrame:
    """One row per document: doc_id, k (hash of doc_id and text), n_shingles, component_id, kept.

    Documents whose sets of ``words``-word shingles have ``100 * intersection >= percent * union`` are linked.
    """
    signed = stage(signatures(docs, words, coordinates), "signatures")
    usable = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = usable.groupBy("set_id").agg(F.min(F.struct("doc_id", "k")).alias("m"), F.any_value("tokens").alias("tokens"))
    reps = stage(classes.select(F.col("m.doc_id").alias("rep"), F.col("m.k").alias("k"), "set_id", "tokens"), "classes")
    # One doc_id may head two classes if its row is there twice with different texts.
    tokens = reps.select("rep", "tokens")
    rarest = stage(prefixes(tokens, matches, coordinates), "prefixes")
    postings = rarest.select(F.explode("prefix").alias("token"), "rep")

    def sets_of(needed: DataFrame) -> DataFrame:
        return shingles_of(needed, docs, reps, words)

    links = stage(confirmed(agreeing(leader_pairs(postings), tokens, matches), sets_of, percent), "links")
    labels = stage(edge_components(links).withColumnsRenamed({"id": "rep"}), "labels")
    more = stage(residual_links(postings, labels, tokens.join(rarest, "rep"), sets_of, matches, percent), "links")
    joined = more.join(labels.select(F.col("rep").alias("a"), F.col("component").alias("ca")), "a", "left")
    joined = joined.join(labels.select(F.col("rep").alias("b"), F.col("component").alias("cb")), "b", "left")
    bridges = joined.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    merged = edge_components(bridges, label="bridges").select(F.col("id").alias("component"), F.col("component").alias("final"))
    groups = (
        reps.select("rep", "set_id")
        .join(labels, "rep", "left")
        .withColumn("component", F.coalesce("component", "rep"))
        .join(merged, "component", "left")
        .select("set_id", F.coalesce("final", "component").alias("component_id"))
    )
    out = signed.join(groups, "set_id", "left").withColumn(
        "component_id", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("component_id")).otherwise(F.col("doc_id"))
    )
    return out.select("doc_id", "k", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(read(spark, folder, "documents"), words=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


ORACLE_SQL = r"""
WITH RECURSIVE
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END AS s FROM words),
classes AS (SELECT list_sort(s) AS s, min(doc_id) AS rep FROM sets WHERE len(s) > 0 GROUP BY 1),
posted AS (SELECT rep, len(s) AS n, unnest(s) AS g FROM classes),
met AS (
  SELECT a.rep AS a, b.rep AS b, count(*) AS common, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM posted a JOIN posted b ON a.g = b.g AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY 1, 2),
links AS (SELECT a, b FROM met WHERE 100 * common >= 80 * (na + nb - common)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT rep AS x, rep AS y FROM classes UNION SELECT r.x, e.b FROM reach r JOIN both_ways e ON r.y = e.a),
groups AS (SELECT x AS rep, min(y) AS component_id FROM reach GROUP BY 1)
SELECT t.doc_id, CAST(len(t.s) AS BIGINT) AS n_shingles, coalesce(g.component_id, t.doc_id) AS component_id,
       coalesce(g.component_id, t.doc_id) = t.doc_id AS kept
FROM sets t LEFT JOIN classes c ON list_sort(t.s) = c.s LEFT JOIN groups g ON c.rep = g.rep
"""
