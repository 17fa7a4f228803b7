"""Every stage of the pipeline against a restatement, and the rows that tables may hold."""

import re
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import FOLDER, none, odd, odd_texts, words  # noqa: F401
from timelane.llm import quality

CLASHING = "doc_id bigint, text string, k string, kept string, gone boolean, lone bigint, row string, score double, label string, n_chars bigint, component_id bigint, s int, `a b` string"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def clashing(spark):
    data = [(i, t, f"k{n}", "kept", True, n, "row", 7.0, "l", -1, -2, n, "z") for n, (i, t) in enumerate(odd_texts())]
    return spark.createDataFrame(data, CLASHING)


@pytest.mark.parametrize("name, function", corpus_pipeline.STAGES)
def test_stages_of_odd_rows(spark, clashing, none, name, function):  # noqa: F811
    """Clashing names pass through, an empty table stays one."""
    assert function(spark, none, FOLDER).count() == 0
    found = function(spark, clashing, FOLDER)
    if name == "best-fit packing":
        assert found.groupBy("doc_id", "piece").count().agg(F.max("count")).first()[0] == 2
        return
    assert found.columns == clashing.columns
    given = {r.s: r for r in clashing.collect()}
    for r in found.collect():
        assert r.doc_id == given[r.s].doc_id
        assert all(r[c] == given[r.s][c] for c in clashing.columns if c not in ("text", "n_chars"))


def shingles(text):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(w)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_near_duplicates_against_all_pairs(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    data = {r.doc_id: shingles(r.text) for r in docs.collect()}
    top = {i: i for i in data}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(data)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if data[a] and data[b] and 100 * len(data[a] & data[b]) >= 80 * len(data[a] | data[b]):
                x, y = sorted((root(a), root(b)))
                top[y] = x
    found = corpus_pipeline.near_duplicate_stage(spark, docs, FOLDER)
    assert sorted(r.doc_id for r in found.collect()) == [i for i in ids if root(i) == i]


def test_substrings_against_all_windows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    data = {r.doc_id: words(r.text) for r in docs.collect()}
    first = {}
    for i in sorted(data):
        for at in range(len(data[i]) - 49):
            first.setdefault(tuple(data[i][at : at + 50]), i)
    want = {}
    for i, w in data.items():
        gone = set()
        for at in range(len(w) - 49):
            if first[tuple(w[at : at + 50])] < i:
                gone.update(range(at, at + 50))
        kept = [x for n, x in enumerate(w) if n not in gone]
        if kept or not gone:
            want[i] = kept
    found = {r.doc_id: (words(r.text), r.n_chars, r.text) for r in corpus_pipeline.substring_stage(spark, docs, FOLDER).collect()}
    assert {i: f[0] for i, f in found.items()} == want
    assert all(n == len(t) for _, n, t in found.values())


def test_rejected_documents_go(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    scores = {r.doc_id: r.score for r in quality.query(spark, FOLDER).collect()}
    found = corpus_pipeline.quality_stage(spark, docs, FOLDER)
    assert rows_of(found) == rows_of(docs.where(F.col("doc_id").isin([i for i, s in scores.items() if s >= quality.THRESHOLD])))


def test_pseudonyms_change_only_text(spark):
    docs = spark.createDataFrame([(1, "write to ann@site.org or 10.1.2.3", 0), (2, "ann@site.org", 0), (3, "clean text", 0), (4, None, 0)], "doc_id bigint, text string, n_chars bigint")
    found = {r.doc_id: r for r in corpus_pipeline.pii_stage(spark, docs, FOLDER).collect()}
    assert found[3].text == "clean text" and found[4].text is None and found[4].n_chars is None
    assert "ann@site.org" not in found[1].text and "10.1.2.3" not in found[1].text
    assert found[2].text in found[1].text and found[2].n_chars == len(found[2].text)
    assert "timelane.llm" in sys.modules
