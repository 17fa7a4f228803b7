"""The operators against plain restatements, and the cases that tables may hold."""

import base64
import hashlib
import json
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.compare import connect, difference, duck_rows, spark_rows
from timelane.llm import best_fit, byte_bpe, catalog, common, embedding_lsh, html_text, minhash_join, permutation_index, pii, quality, substring_dedup, toxicity

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, k string, h string, score string, label string"
WORDS = [f"w{i}" for i in range(400)]


def odd_texts():
    """Null, empty, blank, one word, ties and repeats, very long."""
    rng = np.random.default_rng(5)
    passage = " ".join(rng.choice(WORDS, 70))
    long = " ".join(rng.choice(WORDS, 30_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, f"a {passage} b"), (6, f"c {passage}\nd é 日本"), (6, f"c {passage}\nd é 日本"),
        (7, passage), (8, passage), (None, f"x {passage}"), (9, "x" * 100_000), (10, long), (11, long + " end"), (12, "one"), (None, None),
    ]


@pytest.fixture(scope="module")
def odd(spark):
    """With columns whose names operators use for themselves."""
    return spark.createDataFrame([(i, t, None, None, None, "k", "h", "s", "l") for i, t in odd_texts()], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 0), (5, 1, 1), (5, None, None), (6, 1, 0), (None, 1, 1), (99, 0, 1)], "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("name", sorted(catalog.checks()))
def test_query_matches_sql(spark, name):
    assert difference(spark_rows(catalog.queries()[name](spark, FOLDER)), duck_rows(connect(FOLDER), catalog.checks()[name])) is None


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def by_id(df):
    found = defaultdict(list)
    for r in df.collect():
        found[r[0]].append(r)
    return found


# ---------------------------------------------------------------- 1


@pytest.mark.parametrize("limits", [{}, {"group_rows": 1, "block_rows": 1, "block_nodes": 2, "tree_rows": 10}])
def test_substring_dedup(spark, odd, limits):
    texts = [(i, words(t)) for i, t in odd_texts() if i is not None]
    first = {}
    for i, w in texts:
        for s in range(len(w) - 49):
            key = tuple(w[s : s + 50])
            first[key] = min(i, first.get(key, i))
    found = by_id(substring_dedup.substring_dedup(odd, **limits))
    for i, w in texts:
        gone = {s + j for s in range(len(w) - 49) if first[tuple(w[s : s + 50])] < i for j in range(50)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        for r in found[i]:
            assert (r.n_words, r.n_removed, r.kept_sha256) == (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()), i
            if gone:
                assert words(r.kept) == words(kept)
    assert sum(map(len, found.values())) == len(odd_texts()) and all(r.n_removed == 0 for r in found[None])


def test_suffix_tree_depths():
    rows = np.array([[3, 1, 2], [3, 1, 4], [1, 1, 1], [3, 1, 2]], dtype=np.uint64)
    order, depth = substring_dedup.suffix_tree(rows)
    assert rows[order].tolist() == [[1, 1, 1], [3, 1, 2], [3, 1, 2], [3, 1, 4]] and depth.tolist() == [0, 0, 3, 2]


# ---------------------------------------------------------------- 2, 5


def vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(6, 16))
    rows = [(i, (base[i % 6] + rng.normal(size=16) * 0.05).tolist()) for i in range(60)]
    rows += [(60, None), (61, []), (62, [0.0] * 16), (63, [float("nan")] * 16), (64, [None] * 16), (65, [float("inf")] + [1.0] * 15), (66, rows[0][1]), (None, rows[0][1]), (7, rows[7][1]), (67, [1.0, 2.0])]
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, id string"), rows


def test_embedding_near_dedup(spark):
    df, rows = vectors(spark)
    good = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if i is not None and (i < 60 or i == 66)}
    link = {i: {j for j in good if j != i and good[i] @ good[j] >= 0.95} for i in good}
    for block in (1024, 3):
        found = {r.vec_id: r for r in embedding_lsh.near_duplicates(df, block=block).collect()}
        for i, r in found.items():
            reach, todo = {i}, [i]
            while todo:
                new = link.get(todo.pop(), set()) - reach
                reach |= new
                todo += new
            least = None if i is None else min(reach)
            assert (r.n_links, r.component_id, r.kept) == (len(link.get(i, ())), least, i is None or least == i)
    assert embedding_lsh.near_duplicates(df.limit(0)).count() == 0


def test_nearest_neighbours(spark):
    df, rows = vectors(spark)
    good = {i: np.array(v) for i, v in rows if i is not None and (i < 60 or i == 66)}
    for limits in ({}, {"shard_rows": 7, "block_rows": 2}):
        found = by_id(permutation_index.nearest(df, F.col("vec_id") % 20 == 0, **limits))
        assert sorted(found) == [0, 20, 40]
        for q, hits in found.items():
            exact = sorted((-(good[q] @ good[j]), j) for j in good if j != q)[:20]
            assert [r.vec_id for r in sorted(hits, key=lambda r: r.rank)] == [j for _, j in exact]
    assert permutation_index.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_recall_on_given_vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    x, ids = np.array([r.embedding for r in rows], dtype=float), np.array([r.vec_id for r in rows])
    found, hit, total = by_id(permutation_index.query(spark, "/root/testdata/sf0.1")), 0, 0
    for i in np.flatnonzero(ids % 20 == 0):
        score = x @ x[i]
        score[i] = -np.inf
        exact = set(ids[np.lexsort((ids, -score))[:20]].tolist())
        hit, total = hit + len(exact & {r.vec_id for r in found[ids[i]]}), total + 20
    assert hit / total >= 0.9


# ---------------------------------------------------------------- 3, 6


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_classifier_cases(spark, odd, none, labels, operator):
    rows = operator.classify(odd, labels).collect()
    assert len(rows) == len(odd_texts())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= operator.THRESHOLD) for r in rows)
    fold = 0 if operator is quality else 1
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % operator.FOLDS == fold) for r in rows)
    assert len({r.score for r in rows if r.doc_id == 6}) == 1
    assert operator.classify(none, labels).count() == 0
    assert operator.classify(odd, labels.limit(0)).count() == len(odd_texts())


@pytest.mark.parametrize("operator, label, share", [(quality, "quality", 0.97), (toxicity, "toxic", 0.93)])
def test_held_out_accuracy(spark, operator, label, share):
    folder = "/root/testdata/sf0.1"
    marks = spark.read.parquet(f"{folder}/labels.parquet")
    found = operator.query(spark, folder).where("held_out").join(marks, "doc_id").select("predicted", label).collect()
    assert np.mean([p == y for p, y in found]) >= share


def test_discriminant_matches_numpy(spark):
    rng = np.random.default_rng(1)
    d = len(quality.FEATURES)
    x, y = rng.normal(size=(400, d)) + np.repeat([[0], [1]], 200, axis=0), np.repeat([0, 1], 200)
    model = quality.fit(spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(x, y)], "f array<double>, label int"))
    logs = []
    for c in (0, 1):
        a = x[y == c]
        cov = np.cov(a.T, bias=True)
        cov = (1 - quality.SHRINKAGE) * cov + quality.SHRINKAGE * np.diag(np.diag(cov)) + quality.RIDGE * np.eye(d)
        z = x - a.mean(axis=0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z) - 0.5 * np.linalg.slogdet(cov)[1])
    assert np.allclose(model.score(x), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_unseen_misspelling_is_toxic():
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(WORDS, 40)) for _ in range(300)]
    toxic = np.arange(300) % 2
    texts = [f"{t[:80]} {('horrible', 'horible', 'horribble')[i % 3]} {t[80:]}" if y else t for i, (t, y) in enumerate(zip(texts, toxic))]
    bag = toxicity.calibrated(toxicity.train(texts, toxic), texts, toxic)
    data, bounds = common.utf8_column(pa.array([texts[0], texts[0] + " horrrible"]))
    clean, bad = bag.score(data, bounds, 0, 2)
    assert clean < 0.5 < bad


# ---------------------------------------------------------------- 4, 10


def test_packing(spark, odd, none):
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    coder.encode_special_tokens = True
    rows = best_fit.pack(odd, packer_rows=3).collect()
    ids = {}
    for i, t in odd_texts():
        ids[i, len(ids)] = np.array([*coder.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
    for r in rows:
        same = [x for (i, _), x in ids.items() if i == r.doc_id]
        assert r.ids_crc32 in {zlib.crc32(x[r.start : r.start + r.length].tobytes()) for x in same} and r.start == 2048 * r.piece
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for sequence in places.values():
        sequence.sort()
        assert [o for o, _ in sequence] == np.append(0, np.cumsum([n for _, n in sequence])[:-1]).tolist() and sum(n for _, n in sequence) <= 2048
    assert best_fit.pack(none).count() == 0


def test_packer_takes_the_tightest_and_closes_the_fullest():
    packer = best_fit.Packer(10, 2)
    assert [packer.place(n) for n in (6, 7, 3, 5, 5)] == [(0, 0), (1, 0), (1, 7), (2, 0), (2, 5)]
    packer = best_fit.Packer(10, 2)
    assert [packer.place(n) for n in (6, 8, 9, 2)] == [(0, 0), (1, 0), (2, 0), (0, 6)]


def test_word_ids_equal_the_library():
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    coder.encode_special_tokens = True
    texts = ["ΑΣ ΟΔΟΣ. Σ", "İstanbul ﬁ ① x²", "a\x1cb c\x85d\xa0e", "é ́x don't DON'T 'S", "<|endoftext|> x", "日本語 12345", "a\x00 \x00 b", "Word, word! WORD.; ǅ"]
    for text, ids in zip(texts, best_fit.word_ids(texts, public_tokenizers.path("word_bpe_49k.json"))):
        assert np.frombuffer(ids, dtype="<u4").tolist() == coder.encode(text, add_special_tokens=False).ids


def test_new_letters_go_to_the_model_alone(monkeypatch):
    """No run of letters passes the normaliser and the cutting; its ids are the library's, for every letter."""
    path, passed = public_tokenizers.path(best_fit.VOCABULARY), []
    coder = Tokenizer.from_file(path)

    class Watched:
        def __getattr__(self, name):
            return getattr(coder, name)

        def encode(self, word, **how):
            passed.append(word)
            return coder.encode(word, **how)

        def encode_batch_fast(self, lines, **how):
            passed.extend(word for line in lines for word in line.split())
            return coder.encode_batch_fast(lines, **how)

    monkeypatch.setattr(best_fit, "tokenizer", lambda path: Watched())
    monkeypatch.setattr(best_fit, "MEMO_WORDS", 500)
    every = [chr(c) for c in range(0x250) if best_fit.PLAIN.fullmatch(chr(c))]
    texts = [" ".join(every), " ".join(f"x{a}{b}{a}," for a, b in zip(every, every[1:])), "".join(every), "Plain words, zażółć GĘŚLĄ jaźń; x1 don't ¿qué?"]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in best_fit.word_ids(texts, path)] == [coder.encode(t, add_special_tokens=False).ids for t in texts]
    # Two capitals have their small letter outside the range.
    assert not [w for w in passed if w.isalpha() and max(w) < "\u0250"]
    assert {"x1", "don't", "¿qué?"} <= set(passed)



@pytest.mark.parametrize("sizes", [{}, {"chunk": 300, "overlap": 40, "margin": 8}])
def test_byte_bpe(spark, odd, none, sizes):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    more = spark.createDataFrame([(20, " " * 900 + "q"), (21, "a'" * 400 + "re  \n\n z"), (22, "ab 12" * 200)], "doc_id bigint, text string")
    docs = odd.select("doc_id", "text").where("doc_id IS NULL OR doc_id <> 9").unionByName(more)
    coded = byte_bpe.encode(docs, **sizes)
    rows = coded.collect()
    texts = defaultdict(set)
    for r in docs.collect():
        texts[r.doc_id].add(r.text or "")
    assert len(rows) == docs.count()
    for r in rows:
        exact = {np.array(coder.encode_ordinary(t), dtype="<u4").tobytes(): t for t in texts[r.doc_id]}
        assert r.ids in exact and r.n_tokens == len(r.ids) // 4
        assert r.ids_sha256 == hashlib.sha256(r.ids).hexdigest() and r.decoded_sha256 == hashlib.sha256(exact[r.ids].encode()).hexdigest()
    assert {bytes(r.data) for r in byte_bpe.decode(coded).collect()} == {t.encode() for ts in texts.values() for t in ts}
    assert byte_bpe.encode(none).count() == 0


# ---------------------------------------------------------------- 7


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, none, size, monkeypatch):
    monkeypatch.setattr(minhash_join, "BLOCK_ROWS", 3)
    rng = np.random.default_rng(9)
    base = [rng.choice(WORDS, 60) for _ in range(4)]
    texts = list(odd_texts())
    texts = [(i, t) for i, t in texts if i not in (9, 10, 11)]
    for n in range(80):
        w = base[n % 4].copy()
        w[rng.integers(0, 60, rng.integers(0, 5))] = "Edit"
        texts.append((100 + n, " ".join(w)))
    sets = {}
    for i, t in texts:
        w = words((t or "").translate({c: c + 32 for c in range(65, 91)}))
        n = min(size, len(w))
        sets[i] = frozenset(tuple(w[j : j + n]) for j in range(len(w) - n + 1)) if n else frozenset()
    ids = [i for i in sets if i is not None]
    link = {i: [j for j in ids if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])] for i in ids}
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id bigint, text string, rep string")
    for r in minhash_join.near_duplicates(docs, words=size).collect():
        if r.doc_id is None:
            assert r.component_id is None and r.kept
            continue
        reach, todo = {r.doc_id}, [r.doc_id]
        while todo:
            new = set(link[todo.pop()]) - reach
            reach |= new
            todo += new
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), min(reach), min(reach) == r.doc_id)
    assert minhash_join.near_duplicates(none).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + j) for j in range(1, 50)] + [(7, 7)]
    found = dict(common.edge_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert found == {**{i: 0 for i in range(41)}, **{100 + j: 100 for j in range(50)}}


# ---------------------------------------------------------------- 8


PAGE = "<html><head><title>t</title></head><body>{}</body></html>"


def test_html_cases(spark):
    menu = "<div>Home</div><div>Contact us</div>"
    rows = [
        (1, "http://a.x/n/1", PAGE.format(f"{menu}<p>First &amp; <b>bold<br>text</p><div class='ad'>buy</div><form>f</form>")),
        (2, "http://a.x/n/2", PAGE.format(f"{menu}<p>Second   text<p>more")),
        (3, "http://b.x/1", PAGE.format("<header>h</header><article><header><h1>T</h1></header><p>same</p><section id=comments>c</section></article><footer>f</footer>")),
        (4, "http://b.x/2", PAGE.format("<nav>n</nav><article><p>same</p><script>var t='</p>';</script></article><aside>s</aside>")),
        (5, None, None), (6, "http://c.x/", ""), (7, "http://d.x/a", PAGE.format("<p>mirror")), (8, "http://d.x/b", PAGE.format("<p>mirror")), (1, "http://a.x/n/1", None), (None, "::", "plain < text"),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, lines string")
    found = sorted((r.page_id or 0, r.text, r.n_chars) for r in html_text.main_text(df).collect())
    texts = [(0, "plain < text"), (1, ""), (1, "First & bold text"), (2, "Second text\nmore"), (3, "T\nsame"), (4, "same"), (5, ""), (6, ""), (7, "mirror"), (8, "mirror")]
    assert found == [(i, t, len(t)) for i, t in texts]
    assert html_text.main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "body, text",
    [
        *[(f"<div class='{c}'><nav>n</nav><article><h1>T</h1><p>a</p></article><div>o</div></div>", "T\na") for c in ("with-sidebar", "no-sidebar", "has-header page", "page sidebar", "comments")],
        ("<form id=aspnetForm><header>h</header><article>a</article><aside>s</aside></form>", "a"),
        ("<main><form><article>a</article></form></main>", "a"),
        ("<div id=header><div role=main>a</div></div>", "a"),
        ("<article><div class='article-header'><h1>T</h1></div><div class='elementor-widget-container'>a</div><div class='header'>b</div></article>", "T\na\nb"),
        ("<article><p>a</p><div class='text ad'>x</div><div class='ad-slot'>x</div><form>f</form><ol id=comments><li><article class='comment-body'>c</article></ol></article>", "a"),
        ("<article>a</article><div id=comments><article class='comment-body'>c</article></div><aside><article>teaser</article></aside>", "a"),
        ("<article>area <math><mi>x</mi><mo>=</mo><mn>2</mn></math> here</article>", "area x=2 here"),
        ("<div class='no-sidebar'>a</div><div class='sidebar'>s</div>", "a"),
    ],
)
def test_html_names_are_whole_and_articles_stay(body, text):
    found = html_text.lines_of(PAGE.format(body))
    wanted = html_text.ARTICLE if any(z == html_text.ARTICLE for _, z in found) else html_text.OTHER
    assert "\n".join(t for t, z in found if z == wanted) == text


def test_common_lines_is_a_longest_common_subsequence():
    rng = np.random.default_rng(4)
    for _ in range(60):
        a, b = (rng.integers(0, 5, rng.integers(0, 14)).tolist() for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        places = html_text.common_lines(a, b)
        rest = iter(b)
        assert len(places) == best[-1][-1] and all(a[p] in rest for p in places) and places == sorted(places)


def test_pages_keep_their_articles(spark):
    import html as escapes

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    for r in html_text.query(spark, FOLDER).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(escapes.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b)


# ---------------------------------------------------------------- 9


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits))) % 10 == 0


def feistel(values, moduli, kind, key=pii.KEY):
    v = list(values)
    half = len(v) // 2
    for r in range(pii.ROUNDS):
        other = v[half:] if r % 2 == 0 else v[:half]
        turn = range(half) if r % 2 == 0 else range(half, len(v))
        for i in turn:
            digest = hashlib.sha256(",".join([key, kind, str(r), str(i), ".".join(map(str, other))]).encode()).hexdigest()
            v[i] = (v[i] + int(digest[:12], 16)) % moduli[i]
    return v


def test_pseudonyms(spark):
    texts = {
        1: "mail ann.01@mail3.example.com tel +1 (988) 555-2485 card 4111 1111 1111 1111.",
        2: "ip 29.217.126.147 ssn 078-05-1120 iban GB82WEST12345698765432 born 1980-02-29 or 12/25/2001",
        3: "not 300.1.1.1 nor 666-12-1234 nor 4111111111111112 nor 2023-02-30 nor v2.0.1",
        4: None, 5: "", 6: "again 29.217.126.147 and 4111-1111-1111-1111", 7: "x" * 200_000,
    }
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id bigint, text string, f string")
    out = {r.doc_id: r.text for r in pii.pseudonymise(df).collect()}
    assert [out[i] for i in (3, 4, 5, 7)] == [texts[i] for i in (3, 4, 5, 7)]
    assert re.fullmatch(r"mail [a-z]{3}\.\d\d@mail3\.example\.com tel \+1 \([2-9]\d\d\) [2-9]\d\d-\d{4} card \d{4} \d{4} \d{4} \d{4}\.", out[1])
    card = re.search(r"card ([\d ]+)", out[1])[1]
    body = feistel([1, 1, 1] + [1] * 11, [10] * 14, "card")
    assert luhn(card) and re.sub(r"\D", "", card)[:15] == "4" + "".join(map(str, body))
    assert re.search(r"and ([\d-]+)", out[6])[1].replace("-", "") == card.replace(" ", "")
    ip = feistel([28, 217, 126, 147], [223, 256, 256, 256], "ip")
    address = ".".join(map(str, [ip[0] + 1, *ip[1:]]))
    assert f"ip {address} " in out[2] and f"again {address} " in out[6]
    iban = re.search(r"iban (\w+)", out[2])[1]
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1 and iban != "GB82WEST12345698765432"
    assert all(a not in str(out) for a in ("ann.01@", "555-2485", "29.217", "078-05", "1980-02-29", "12/25/2001"))


def remainder_97(account):
    bare = account.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97


@pytest.mark.parametrize(
    "before, value, after",
    [
        ("to ", "DE89 3704 0044 0532 0130 00", " of us"), ("", "GB82 WEST 1234 5698 7654 32", ""), ("", "BE68 5390 0754 7034", " ON 12 EUR"), ("", "DE89370400440532013000", " 12"),
        ("at ", "2023-01-02", "T10:00"), ("", "1980-02-29", "T23:59:59.5+01:00"),
        ("call ", "555 123 4567", ", now"), ("", "020 7946 0958", ""), ("", "01 42 68 53 00", "."), ("seat AT61 ", "4111 1111 1111 1111", ""),
        ("password=", "aZ9" * 100, " end"), ("", "0a1b2c3d" * 16, ""), ("", "jo.do", "@" + "a." * 12 + "example.org"),
    ],
)
def test_values_in_common_forms(spark, before, value, after):
    (out,) = pii.pseudonymise(spark.createDataFrame([(1, before + value + after)], "doc_id int, text string")).first()[1:]
    assert out.startswith(before) and out.endswith(after) and len(out) == len(before + value + after)
    new = out[len(before) : len(out) - len(after)]
    shape = [re.sub("[0-9]", "0", re.sub("[A-Za-z]", "a", x)) for x in (new, value)]
    assert new != value and (shape[0] == shape[1] or re.fullmatch("[0-9a-f]{128}", new))
    if re.match("[A-Z]{2}[0-9]{2}", value):
        assert remainder_97(value) == 1 and remainder_97(new) == 1


def test_dates_stay_different(spark):
    days = spark.range(4000).select(F.date_format(F.date_add(F.lit("1995-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    assert pii.pseudonymise(days).select(F.to_date("text").alias("d")).where("d IS NOT NULL").distinct().count() == 4000


def test_main_path_has_no_python(spark):
    plan = pii.query(spark, FOLDER)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---------------------------------------------------------------- pipeline


def test_pipeline(spark):
    import corpus_pipeline

    docs = common.read(spark, FOLDER, "documents")
    columns, sizes = docs.columns, [docs.count()]
    kept = []
    for _, function in corpus_pipeline.STAGES:
        docs = common.stage(function(spark, docs, FOLDER), "test")
        kept.append(docs)
        sizes.append(docs.count())
    assert all(d.columns == columns for d in kept[:-1]) and sizes[0] > sizes[1] > sizes[2] >= sizes[3] == sizes[4]
    first = {r.doc_id for r in quality.query(spark, FOLDER).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept[0].collect()} == first
    second = {r.doc_id for r in minhash_join.near_duplicates(kept[0]).where("kept").collect()}
    assert {r.doc_id for r in kept[1].collect()} == second
    assert all(r.n_chars == len(r.text) for r in kept[3].collect())
    total = kept[4].agg(F.sum("length")).first()[0]
    whole = best_fit.pack(kept[3]).agg(F.sum("length")).first()[0]
    assert total == whole and json.dumps(sizes)


def test_pipeline_keeps_rows_without_an_id(spark):
    import corpus_pipeline

    data = [(None, "same", "en", "a"), (None, "same", "de", "b"), (None, None, "en", "a"), (None, None, "en", "a"), (1, "one", "fr", "b"), (1, "one", "en", "b"), (1, "one", "en", "a"), (2, "two", None, None)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string")
    wanted = sorted([*data[:4], (1, "one", "en", "a"), data[7]], key=repr)
    for rows in (docs, docs.orderBy(F.desc("lang"))):
        assert sorted(map(tuple, corpus_pipeline.near_duplicate_stage(spark, rows, FOLDER).collect()), key=repr) == wanted


def test_every_page_is_differenced(spark):
    """Also pages whose lines are all settled by their markup."""
    html = lambda n: f"<nav>Home</nav><article><p>Same line</p><p>Own line {n}</p></article>"
    rows = [(n, f"http://a.example/x/{n}", html(n)) for n in range(3)] + [(9, "http://b.example/alone", html(9)), (10, "http://a.example/x/empty", None)]
    found = {r.page_id: r for r in html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert {n: r.n_shared for n, r in found.items()} == {0: 2, 1: 2, 2: 2, 9: None, 10: None}
    assert all(r.text == ("" if n == 10 else f"Same line\nOwn line {n}") for n, r in found.items())


def test_words_do_not_outlive_their_task():
    list(best_fit.word_ids(["some words", "more words"], public_tokenizers.path(best_fit.VOCABULARY)))
    kept = common.worker_cache()[f"words of {public_tokenizers.path(best_fit.VOCABULARY)}"]
    assert isinstance(kept, Tokenizer)
