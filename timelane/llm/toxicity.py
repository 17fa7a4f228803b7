"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A text is a bag of the byte n-grams of its words (with word bounds), each hashed to one of ``2 ** BITS`` embeddings.  The
embeddings of a stretch of ``window`` words are averaged and go through a linear softmax of two classes; both are
trained together in NumPy.  A misspelt word never seen shares most of its n-grams, and so most of its vector, with the
word it stands for.

A text is as toxic as its most toxic stretch, so a few words in a very long text weigh as much as in a short one.
Training follows the same rule: of a toxic text its currently worst stretch is learnt, of a clean text its worst and a
few random ones.  As softmax and average are linear, a trained model scores with one number per n-gram.

The model is fitted on a bounded sample: per class at most ``sample_rows`` labelled rows of at most ``sample_chars``
characters, by hash of doc_id; of repeated rows one is learnt.  Every whole text is scored.

Null and empty texts have no n-gram; their score is that of the softmax bias.  Labels that are null or belong to no
document are ignored; of several labels of one doc_id the largest counts.  Without labels of both classes every score
is 0.  Repeated rows get equal results, extra columns are ignored, a null doc_id is never held out nor learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from timelane.llm.common import crc32_text, ngram_hash, read, slices, utf8_column, word_table

GRAMS, BITS, DIM, WINDOW = (3, 4, 5, 6), 16, 8, 3
SAMPLE_ROWS, SAMPLE_CHARS = 1500, 8192
STEPS, BATCH, RATE = 240, 512, 0.03
#: Bytes of the sample split, and words summed, at a time in training.
TRAIN_BYTES, TRAIN_WORDS = 1 << 18, 1 << 16
#: Every so many-th text of the sample is kept from training and sets scale and bias of the score.
CALIBRATION = 5
FOLDS, THRESHOLD = 3, 0.7


def grams(data: np.ndarray, bounds: np.ndarray, first: int, last: int) -> Iterator[tuple]:
    """Row bounds over words, then for each n the buckets and the words that own them."""
    t = word_table(data, bounds, first, last, lower=True)
    lengths = t.end - t.start + 1
    begin = np.cumsum(lengths) - lengths
    yield t.rows, len(lengths)
    if len(lengths) == 0:
        return
    # Every word with a bound (byte 1) before it, and one at the end.
    index = np.arange(int(lengths.sum()) + 1)
    word = np.repeat(np.arange(len(lengths)), lengths)
    place = np.minimum(index[:-1] - np.repeat(begin - t.start, lengths) - 1, len(t.data) - 1)
    symbols = np.append(t.data[place], 1).astype(np.uint64)
    symbols[begin] = 1
    bound = np.append(0, np.cumsum(symbols == 1))
    for n in GRAMS:
        if len(symbols) < n:
            continue
        inner = bound[n - 1 : len(symbols) - 1 + 1][: len(symbols) - n + 1] - bound[1 : len(symbols) - n + 2]
        keep = np.flatnonzero(inner == 0)
        hashes = ngram_hash(symbols + np.uint64(n << 8), n)[keep]
        # The first symbol is the word's own bound or one of its letters; the bound after a word belongs to the next.
        yield (hashes >> np.uint64(64 - BITS)).astype(np.int64), word[np.minimum(keep, len(word) - 1)]


@dataclass
class Bag:
    """Scores of n-grams (embedding times softmax weights) and the bias."""

    table: np.ndarray
    bias: float
    window: int

    def score(self, data: np.ndarray, bounds: np.ndarray, first: int, last: int) -> np.ndarray:
        parts = grams(data, bounds, first, last)
        rows, n = next(parts)
        sums, counts = np.zeros(n), np.zeros(n)
        for bucket, word in parts:
            sums += np.bincount(word, weights=self.table[bucket], minlength=n)
            counts += np.bincount(word, minlength=n)
        logit = np.full(len(rows) - 1, self.bias)
        total, of = np.append(0, np.cumsum(sums)), np.append(0, np.cumsum(counts))
        start = np.arange(n)
        size = np.diff(rows)
        stop = np.minimum(start + self.window, np.repeat(rows[1:], size))
        # Stretches at the end of a text reach back, so all are of full length if the text is.
        start = np.maximum(np.repeat(rows[:-1], size), stop - self.window)
        means = (total[stop] - total[start]) / np.maximum(1, of[stop] - of[start])
        full = size > 0
        if full.any():
            logit[full] += np.maximum.reduceat(means, rows[:-1][full])
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -700, 700)))


def train(texts: list[str], toxic: np.ndarray, window: int = WINDOW, seed: int = 7) -> Bag:
    rng = np.random.default_rng(seed)
    data, bounds = utf8_column(pa.array(texts, pa.string()))
    # Slice by slice, and two bytes per n-gram, so the driver's memory holds little more than the sample.
    rows, bucket, counts = [np.zeros(1, dtype=np.int64)], [], []
    for first, last in slices(bounds, TRAIN_BYTES):
        parts = grams(data, bounds, first, last)
        own, n = next(parts)
        rows.append(own[1:] + rows[-1][-1])
        found = list(parts)
        buckets, words = (np.concatenate([np.zeros(0, np.int64), *[f[i] for f in found]]) for i in range(2))
        bucket.append(buckets[np.argsort(words, kind="stable")].astype(np.uint16))
        counts.append(np.bincount(words, minlength=n))
    rows, bucket = np.concatenate(rows), np.concatenate(bucket)
    n, at = int(rows[-1]), np.append(0, np.cumsum(np.concatenate(counts)))
    size = np.diff(rows)
    first = np.arange(n)
    stop = np.minimum(first + window, np.repeat(rows[1:], size))
    first = np.maximum(np.repeat(rows[:-1], size), stop - window)
    lo, hi = at[first], at[stop]

    embedding = rng.normal(0, 0.1, (1 << BITS, DIM))
    weight, bias = rng.normal(0, 0.1, DIM), np.zeros(1)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (embedding, weight, bias)]
    steps = 0
    full = np.flatnonzero(size > 0)
    epoch = -1
    while steps < STEPS:
        epoch += 1
        some = lambda docs, times: np.concatenate([rows[docs] + (rng.random(len(docs)) * size[docs]).astype(int) for _ in range(times)])
        bad, good = full[toxic[full] == 1], full[toxic[full] == 0]
        if epoch == 0:
            chosen, target = np.append(some(bad, 4), some(good, 4)), np.repeat([1.0, 0.0], [4 * len(bad), 4 * len(good)])
        else:
            table, value = embedding @ weight, np.zeros(n + 1)
            for x in range(0, n, TRAIN_WORDS):
                y = min(n, x + TRAIN_WORDS)
                sums = np.append(0, np.cumsum(table[bucket[at[x] : at[y]]]))
                value[x + 1 : y + 1] = value[x] + sums[at[x + 1 : y + 1] - at[x]]
            means = (value[stop] - value[first]) / np.maximum(1, hi - lo)
            worst = {int(d): rows[d] + int(np.argmax(means[rows[d] : rows[d + 1]])) for d in full}
            pos, neg = [worst[d] for d in bad], np.append(np.array([worst[d] for d in good]), some(good, 3))
            for d in bad:
                # Further stretches that are taken for toxic already, apart from the worst.
                others = np.flatnonzero(means[rows[d] : rows[d + 1]] + bias[0] > 0) + rows[d]
                pos += others[np.abs(others - worst[d]) >= window][:: window][:3].tolist()
            pos = np.repeat(np.array(pos), 2)
            chosen, target = np.append(pos, neg), np.repeat([1.0, 0.0], [len(pos), len(neg)])
        shuffled = rng.permutation(len(chosen))
        for x in range(0, len(shuffled), BATCH):
            pick = chosen[shuffled[x : x + BATCH]]
            y = target[shuffled[x : x + BATCH]]
            n_grams = np.maximum(1, hi[pick] - lo[pick])
            ids = bucket[np.repeat(lo[pick], n_grams) + np.arange(n_grams.sum()) - np.repeat(np.cumsum(n_grams) - n_grams, n_grams)]
            hidden = np.add.reduceat(embedding[ids], np.cumsum(n_grams) - n_grams) / n_grams[:, None]
            error = 1 / (1 + np.exp(-np.clip(hidden @ weight + bias[0], -50, 50))) - y
            shared = np.bincount(ids, weights=np.repeat(error / n_grams, n_grams), minlength=1 << BITS)
            gradients = (np.outer(shared, weight), hidden.T @ error, np.array([error.sum()]))
            steps += 1
            for p, g, (m, v) in zip((embedding, weight, bias), gradients, state):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.99**steps)) + 1e-8)
    return Bag(embedding @ weight, float(bias[0]), window)


def calibrated(bag: Bag, texts: list[str], toxic: np.ndarray) -> Bag:
    """Scale and bias by a logistic fit of the text scores, with a weak pull towards no change."""
    data, bounds = utf8_column(pa.array(texts, pa.string()))
    p = np.clip(bag.score(data, bounds, 0, len(texts)), 1e-12, 1 - 1e-12)
    x = np.column_stack([np.log(p / (1 - p)), np.ones(len(p))])
    prior = np.array([1.0, 0.0])
    w, pull = prior.copy(), 1.0
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        gradient = x.T @ (q - toxic) + pull * (w - prior)
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + pull * np.eye(2), gradient)
        w = w - np.clip(step, -1, 1)
    scale = max(w[0], 0.05)
    return Bag(bag.table * scale, bag.bias * scale + w[1], bag.window)


def held_out(doc_id: str = "doc_id", folds: int = FOLDS) -> Column:
    return F.coalesce(crc32_text(doc_id) % folds == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS, window: int = WINDOW) -> Bag:
    marks = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # The sample is chosen by id, so no text is shuffled; then its texts, a bounded number, are read by a second scan.
    usable = docs.where(F.length("text") <= sample_chars).select("doc_id", F.xxhash64("text").alias("t")).distinct()
    known = marks.join(usable, "doc_id").select("toxic", "doc_id", "t", F.xxhash64("doc_id").alias("turn"))
    chosen = [known.where(F.col("toxic") == label).orderBy("turn", "t").limit(sample_rows) for label in (0, 1)]
    chosen = sorted((tuple(r) for part in chosen for r in part.collect()), key=lambda r: (r[0], r[3], r[2]))
    wanted = docs.sparkSession.createDataFrame(chosen, "toxic int, doc_id bigint, t bigint, turn bigint")
    read_again = docs.where(F.length("text") <= sample_chars).select("doc_id", "text", F.xxhash64("text").alias("t"))
    texts_of = {(r["doc_id"], r["t"]): r["text"] for r in read_again.join(F.broadcast(wanted.select("doc_id", "t")), ["doc_id", "t"]).collect()}
    sample = [(texts_of[doc_id, t], label) for label, doc_id, t, _ in chosen]
    toxic = np.array([label for _, label in sample])
    if len(set(toxic.tolist())) < 2:
        return Bag(np.zeros(1 << BITS), -np.inf, window)
    texts, kept = [text for text, _ in sample], np.arange(len(sample)) % CALIBRATION == 0
    if len(set(toxic[kept])) < 2 or len(set(toxic[~kept])) < 2:
        return train(texts, toxic, window)
    bag = train([t for t, k in zip(texts, kept) if not k], toxic[~kept], window)
    return calibrated(bag, [t for t, k in zip(texts, kept) if k], toxic[kept])


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    model = fit(docs, labels, sample_rows, sample_chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = utf8_column(batch["text"])
            for first, last in slices(bounds):
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["held_out"], pa.array(model.score(data, bounds, first, last))], names=["doc_id", "held_out", "score"])

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    scored = source.mapInArrow(run, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return classify(read(spark, folder, "documents"), read(spark, folder, "labels"))
