"""Periodic runs, centroid clusters and line dedup against plain restatements, and the cases that tables may hold."""

import hashlib
import os
import random
import subprocess
import sys
from collections import Counter, defaultdict
from functools import partial

import numpy as np
import pytest
from pyspark import cloudpickle

from tests.llm.test_operators import FOLDER, by_id, none, odd, words  # noqa: F401
from timelane.llm import best_fit, byte_bpe, catalog, centroid_clusters, html_text, line_dedup, periodic_runs, permutation_index, substring_dedup
from timelane.llm.common import stage

VECTORS = "vec_id bigint, embedding array<float>, v string, cluster string, distance string"

# ---------------------------------------------------------------- 11


def plain_runs(w, least=12):
    n, out = len(w), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, 2 * q):
                part = w[i : i + size]
                if not any(all(part[x] == part[x + r] for x in range(size - r)) for r in range(1, q)):
                    out.add((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda run: (run[0], run[2]))


def plain_rest(w, runs):
    gone = {i for start, size, q in runs for i in range(start + q, start + size)}
    return [x for i, x in enumerate(w) if i not in gone]


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_against_all_stretches(least):
    rng = random.Random(least)
    for _ in range(400):
        docs = []
        for _ in range(rng.randint(1, 4)):
            w = [str(rng.randrange(rng.choice([1, 2, 2, 3]))).encode() for _ in range(rng.randint(0, 50))]
            if w and rng.random() < 0.6:
                a, p = rng.randrange(len(w)), rng.randint(1, 8)
                w = w[:a] + (w[a : a + p] * 60)[: len(w) - a]
            docs.append(w)
        assert periodic_runs.runs_of(docs, least) == [plain_runs(w, least) for w in docs]


def test_long_runs():
    for unit, n in ((1, 20_000), (3, 30_001)):
        w = [str(i % unit).encode() for i in range(n)]
        assert periodic_runs.runs_of([w, w]) == [[(0, n, unit)]] * 2
    fibonacci = [b"a"], [b"a", b"b"]
    while len(fibonacci[1]) < 300:
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    assert periodic_runs.runs_of([fibonacci[1]]) == [plain_runs(fibonacci[1])]


def test_runs_of_odd_rows(spark, odd, none):  # noqa: F811
    assert periodic_runs.periodic_runs(none).collect() == []
    rows = by_id(periodic_runs.periodic_runs(odd.withColumnRenamed("k", "runs")))
    assert len(rows[6]) == 2 and rows[6][0] == rows[6][1]
    assert {r.n_words for r in rows[None]} == {0, 71}
    for r in odd.collect():
        for found in rows[r.doc_id]:
            if found.n_words == len(words(r.text)) and found.n_words < 100:
                assert [tuple(x) for x in found.runs] == plain_runs(words(r.text))
    docs = spark.createDataFrame([(1, "a b c " * 8 + "x"), (2, "a\tb\n" * 5), (3, "a b " * 6)], "doc_id bigint, text string")
    found = by_id(periodic_runs.periodic_runs(docs))
    assert found[1][0].collapsed == "a b c x" and [tuple(r) for r in found[1][0].runs] == [(0, 24, 3)]
    assert not found[2][0].runs and found[2][0].collapsed == "a b a b a b a b a b"
    assert found[3][0].collapsed == "a b"


def test_runs_query(spark):
    """Small documents by brute force; the contract's rewriting restated word by word."""
    import zlib

    rows = by_id(catalog.queries()["op11_periodic_runs"](spark, FOLDER))
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert len(rows) == len(docs)
    compared = rewritten = 0
    for d in docs:
        w, h = words(d.text), zlib.crc32(str(d.doc_id).encode())
        n, g = len(w), h // 10
        if n > 400:
            continue
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            rewritten += 1
        runs = plain_runs(w)
        (r,) = rows[d.doc_id]
        top = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *top)
        assert r.exponent_milli == (1000 * top[1] // top[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{l},{p}\n" for s, l, p in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(plain_rest(w, runs)).encode()).hexdigest()
        compared += 1
    assert compared > 50 and rewritten > 5


# ---------------------------------------------------------------- 12


def test_nearest_against_all_distances():
    rng = np.random.default_rng(3)
    for _ in range(100):
        k, d, top = int(rng.integers(1, 12)), int(rng.integers(1, 9)), int(rng.choice([1, 5, 1000]))
        c, x = rng.integers(-top, top + 1, (k, d)), rng.integers(-top - 2, top + 3, (50, d))
        all_ = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        winner, best = centroid_clusters.Lists(c).nearest(x)
        assert (winner == all_.argmin(axis=1)).all() and (best == all_.min(axis=1)).all()


def test_clusters_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [4.0, 0.5]), (3, [4.0, 0.5]), (None, [4.0, 0.0]), (5, [-0.001, 0.0])]
    bad = [(6, None), (7, []), (8, [1.0]), (9, [nan, 0.0]), (10, [inf, 0.0]), (11, [None, 1.0]), (12, [1.0, 2.0, 3.0])]
    table = spark.createDataFrame([(i, v, "v", "c", "d") for i, v in good + bad], VECTORS)
    rows = centroid_clusters.clusters(table, k=2, rounds=3, dims=2, scale=4).collect()
    # Starts are the rows with the least digests, a repeated row among them; restated with plain loops.
    whole = [(i, tuple(int(np.floor(4 * x)) for x in v)) for i, v in good]
    start = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in whole if i is not None)
    centroids = [v for _, v in start[:2]]
    near = lambda v: min(range(2), key=lambda c: (sum((a - b) ** 2 for a, b in zip(v, centroids[c])), c))
    for _ in range(3):
        groups = defaultdict(list)
        for _, v in whole:
            groups[near(v)].append(v)
        centroids = [tuple(sum(x) // len(groups[c]) for x in zip(*groups[c])) if groups[c] else centroids[c] for c in range(2)]
    assert Counter((r.vec_id, r.cluster, tuple(r.centroid)) for r in rows) == Counter((i, near(v), centroids[near(v)]) for i, v in whole)
    assert {r.inertia for r in rows} == {sum(r.distance for r in rows)}
    empty = centroid_clusters.clusters(table.limit(0), k=2, dims=2)
    assert empty.collect() == [] and empty.columns == centroid_clusters.clusters(table, k=2, dims=2, rounds=1).columns
    huge = spark.createDataFrame([(1, [1e30, 0.0], "", "", "")], VECTORS)
    with pytest.raises(Exception, match="lies beyond"):
        centroid_clusters.clusters(huge, dims=2).collect()


# ---------------------------------------------------------------- 13


def plain_lines(rows, min_chars, min_docs):
    blanks = " \t\n\v\f\r"
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(blanks))
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None:
                holders[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("settings", [{}, {"shard_keys": 2}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "shard_keys": 2, "unit_rows": 3}])
def test_lines_against_sets(spark, odd, none, settings):  # noqa: F811
    rng = random.Random(4)
    pool = [f"{'Ä' if i % 3 else 'a'}line {i} " + "x" * (i % 7) for i in range(20)]
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for i in range(60):
        picks = [rng.choice([str.upper, str, lambda s: f" \t{s}\r"])(rng.choice(pool)) for _ in range(rng.randint(0, 8))]
        rows.append((rng.choice([i, i, None, 7]), "\n".join(["the very common line", *picks]) + rng.choice(["", "\n"])))
    docs = spark.createDataFrame([(i, t, "a", "b", "shard") for i, t in rows], "doc_id bigint, text string, a string, b string, shard string")
    found = line_dedup.line_dedup(docs, min_chars=9, min_docs=3, **settings)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_lines(rows, 9, 3)
    assert line_dedup.line_dedup(none, **settings).collect() == []


def test_shard_numbers_have_no_gap():
    rng = np.random.default_rng(1)
    for n in (1, 2, 63, 5_000):
        a, b = rng.integers(0, 1 << 63, (2, n), dtype=np.uint64)
        a[: n // 2] = a[0]  # equal in one half
        shard = line_dedup.Shard.built(a, b, np.arange(n), np.arange(n))
        number = shard.place(a, b)
        assert sorted(number.tolist()) == list(range(n))
        assert (shard.keepers[number] == np.arange(n)).all()
        other = rng.integers(0, 1 << 63, (2, 10_000), dtype=np.uint64)
        assert not shard.lost(*other, np.full(10_000, -1), np.ones(10_000, bool), 0).any()


# ---------------------------------------------------------------- workers


@pytest.mark.parametrize("make", ["words", "ranks", "places", "runs", "lines"])
def test_workers_need_no_copy_of_the_package(tmp_path, make):
    """What Spark sends runs in a process that cannot import the package."""
    import public_tokenizers

    functions = {
        "words": partial(best_fit.word_ids, ["some words", ""], public_tokenizers.path(best_fit.VOCABULARY)),
        "ranks": partial(byte_bpe.encoding, public_tokenizers.path(byte_bpe.RANKS)),
        "places": partial(byte_bpe.boundaries, "some words"),
        "runs": partial(periodic_runs.runs_of, [[b"a"] * 20]),
        "lines": partial(line_dedup.digests, [b"a"]),
    }
    sent = tmp_path / "function"
    sent.write_bytes(cloudpickle.dumps(functions[make]))
    code = f"import sys, pickle; assert not any('repo' in p for p in sys.path); found = pickle.load(open({str(sent)!r}, 'rb'))(); found = list(found) if hasattr(found, '__next__') else found; assert 'timelane' not in sys.modules"
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": os.path.dirname(os.path.dirname(public_tokenizers.__file__))}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_equal_rows_are_spread_over_packers(spark):
    from pyspark.sql import functions as F

    parts = spark.createDataFrame([(None, 0, 0, 100, 7)] * 2000, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    packed = best_fit.best_fit(stage(parts, "equal"), packer_rows=100)
    sizes = [r["count"] for r in packed.groupBy(F.shiftright("sequence_id", 40)).count().collect()]
    assert sum(sizes) == 2000 and len(sizes) == 20 and max(sizes) < 200


# ---------------------------------------------------------------- 5


@pytest.mark.parametrize("spread", [0.0, 0.7, 1.2])
def test_recall_of_a_full_shard(spread):
    """A shard of registered size, searched by footrule: unit vectors, and lengths that vary."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(permutation_index.SHARD_ROWS, 64)) + 2 * rng.normal(size=(40, 64))[rng.integers(0, 40, permutation_index.SHARD_ROWS)]
    x = x / np.sqrt((x**2).sum(axis=1))[:, None] * np.exp(rng.normal(0, spread, len(x)))[:, None]
    pivots = x[: permutation_index.PIVOTS] / np.sqrt((x[: permutation_index.PIVOTS] ** 2).sum(axis=1))[:, None]
    order = np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, : permutation_index.NEAR]
    ids = np.arange(len(x))
    shard = permutation_index.Shard(ids, x, order, len(pivots))
    hit = 0
    for q in range(0, 8000, 100):
        score = x @ x[q]
        score[q] = -np.inf
        found, _ = shard.search(q, x[q], order[q], permutation_index.CANDIDATES, 20)
        hit += len(set(np.argsort(-score)[:20].tolist()) & set(found.tolist()))
    assert hit / (80 * 20) >= 0.9


def test_units_of_few_queries(spark):
    """Several shards and blocks give what one unit gives, by footrule."""
    from pyspark.sql import functions as F

    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    settings = {"pivots": 16, "near": 8, "candidates": 10_000}
    whole = permutation_index.nearest(table, F.col("vec_id") % 3 == 0, k=5, **settings).collect()
    parts = permutation_index.nearest(table, F.col("vec_id") % 3 == 0, k=5, shard_rows=40, block_rows=20, **settings).collect()
    whole, parts = sorted(map(tuple, whole)), sorted(map(tuple, parts))
    assert [r[:3] for r in whole] == [r[:3] for r in parts]
    assert np.allclose([r[3] for r in whole], [r[3] for r in parts], rtol=1e-12)


# ---------------------------------------------------------------- 8


def test_pages_against_plain_differencing(spark):
    """The whole operator restated page by page: neighbours by sorted paths, shared lines gone, article lines kept."""
    rng = random.Random(12)
    rows = []
    for host in range(12):
        for path in rng.sample(range(100), rng.randint(1, 6)):
            blocks = [f"<div>{rng.choice(['Home', 'About us', 'Contact', f'own {rng.randrange(999)}'])}</div>" for _ in range(rng.randint(0, 6))]
            if rng.random() < 0.5:
                blocks.insert(rng.randint(0, len(blocks)), f"<article><p>text {path}</p><p>Home</p></article>")
            rows.append((len(rows), f"http://h{host}.x/n/{path:02d}", f"<html><body>{''.join(blocks)}<footer>f</footer></body></html>"))
    want = {}
    for page, url, html in rows:
        same = sorted((u, p) for p, u, _ in rows if u.split("/")[2] == url.split("/")[2])
        at = same.index((url, page))
        near = [(len(os.path.commonprefix([url, same[i][0]])), -i, same[i][1]) for i in (at - 1, at + 1) if 0 <= i < len(same)]
        lines = html_text.lines_of(html)
        shared = None
        if near:
            theirs = html_text.lines_of(rows[max(near)[2]][2])
            names = {text: n for n, (text, _) in enumerate(lines + theirs)}
            if theirs:
                shared = set(html_text.common_lines([names[t] for t, _ in lines], [names[t] for t, _ in theirs]))
        marked = any(z == html_text.ARTICLE for _, z in lines)
        if shared is None:
            shared = set(range(len(lines))) if marked else set()
        kept = [t for i, (t, z) in enumerate(lines) if z == html_text.ARTICLE or z == html_text.OTHER and i not in shared]
        want[page] = "\n".join(kept or [t for t, z in lines if z != html_text.FURNITURE])
    found = html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r.page_id: r.text for r in found} == want and len(found) == len(rows)


@pytest.mark.parametrize(
    "body, texts",
    [
        ("<div>Menu</div><div class=content><p>Story {i}</p></div><article>Teaser</article>", "Story {i}\nTeaser"),
        ("<div>Menu</div><h1>Title {i}</h1><article>Body</article>", "Title {i}\nBody"),
        ("<div class=top-menu>m{i}</div><div class=cookie-banner>c{i}</div><p>Story {i}</p>", "Story {i}"),
        ("<div class=no-sidebar><p>Story {i}</p></div>", "Story {i}"),
    ],
)
def test_text_beside_articles(spark, body, texts):
    rows = [(i, f"http://a.x/{i}", f"<html><body>{body.format(i=i)}</body></html>") for i in range(2)]
    found = html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r.page_id: r.text for r in found} == {i: texts.format(i=i) for i in range(2)}


# ---------------------------------------------------------------- 1


def test_facts_of_frequent_keys(spark, monkeypatch):
    """Each row gets the facts of its key once, whether they travel or both sides are shuffled."""
    from timelane.functions.sides import Sides

    rows = spark.createDataFrame([(n, n, n % 5 if n % 3 else 7, bytes([n % 2])) for n in range(60)], "k bigint, s int, h bigint, c binary")
    facts = rows.where("h <> 4").groupBy("h", "c").count().withColumnRenamed("count", "n").selectExpr("h", "c", "n", "h * 10 + n AS lo")
    known = {(r.h, bytes(r.c)): r.lo for r in facts.collect()}
    for limit in (64 << 20, 0):
        monkeypatch.setattr(Sides, "broadcast_bytes", limit)
        found = substring_dedup.sized_join(rows, facts, ["h", "c"], most=4)
        assert sorted((r.k, r.h, bytes(r.c), r.lo) for r in found.collect()) == sorted((r.k, r.h, bytes(r.c), known.get((r.h, bytes(r.c)))) for r in rows.collect())
