"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each whole text becomes a vector of ``FEATURES`` (logarithms of counts and shares of its words and characters).  Means
and covariances of the two classes come from all labelled training rows: Spark sums counts, vectors and products, so
the driver sees a few hundred numbers at any size.  A covariance is shrunk towards its diagonal.  The score is the
posterior of class 1 from the difference of the two log densities; the Mahalanobis distances use Cholesky factors that
are computed once and sent along.

Nulls and empty texts have the vector of a text without words and get a score as well.  Labels that are null or belong
to no document are ignored; of several labels of one doc_id the largest counts.  Without labels every score is 0.5, with
one class only its share.  Repeated rows get equal results, extra columns are ignored, a null doc_id is never held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from timelane.llm.common import MIX_B, crc32_text, mix, read, slices, stage, utf8_column, word_table

FEATURES = ("words", "word_length", "upper", "digits", "marks", "repeats", "old_words", "old_pairs", "bare_marks", "mark_ends")
SHRINKAGE, RIDGE, FOLDS, FLOOR = 0.02, 1e-3, 5, 0.005
THRESHOLD = 0.3


def statistics(data: np.ndarray, bounds: np.ndarray, first: int, last: int) -> np.ndarray:
    """One row of FEATURES per text."""
    t = word_table(data, bounds, first, last)
    b, at = t.data, bounds[first : last + 1] - bounds[first]

    def per_row(mask: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(mask, dtype=np.int64))
        return total[at[1:]] - total[at[:-1]]

    def per_word_row(mask: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(mask, dtype=np.int64))
        return total[t.rows[1:]] - total[t.rows[:-1]]

    low, high = (b >= 97) & (b <= 122), (b >= 65) & (b <= 90)
    lead = b >= 0xC2
    # Capitals of Latin-1: C3 80 .. C3 9E.
    accents = np.zeros(len(b), dtype=bool)
    if len(b) > 1:
        accents[:-1] = (b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E)
    digit = (b >= 48) & (b <= 57)
    mark = (b > 32) & (b < 127) & ~(low | high | digit)
    chars = np.maximum(1, per_row((b & 0xC0) != 0x80))
    letters = np.maximum(1, per_row(low | high | lead))
    n = np.diff(t.rows)
    words = np.maximum(1, n)

    solid_end = t.end - 1
    ends = mark[solid_end] if len(solid_end) else np.zeros(0, bool)
    marks_in = np.append(0, np.cumsum(mark, dtype=np.int64))
    bare = (marks_in[t.end] - marks_in[t.start]) == (t.end - t.start)
    row_of = np.repeat(np.arange(len(n)), n)
    same_row = row_of[1:] == row_of[:-1]
    again = np.append(False, (t.hash[1:] == t.hash[:-1]) & same_row) if len(t.hash) else np.zeros(0, bool)
    pair = mix(t.hash[1:] * MIX_B + t.hash[:-1])
    kinds, pairs = np.zeros(len(n)), np.zeros(len(n))
    for i, (x, y) in enumerate(zip(t.rows[:-1], t.rows[1:])):
        if y > x:
            kinds[i] = len(np.unique(t.hash[x:y]))
            pairs[i] = len(np.unique(pair[x : y - 1]))

    def share(count, of) -> np.ndarray:
        return np.log(count / of + FLOOR)

    return np.column_stack(
        [
            np.log1p(n),
            np.log1p(per_word_row(t.end - t.start) / words),
            share(per_row(high | accents), letters),
            share(per_row(digit), chars),
            share(per_row(mark), chars),
            share(per_word_row(again), words),
            share(n - kinds, words),
            share(np.maximum(0, n - 1 - pairs), np.maximum(1, n - 1)),
            share(per_word_row(bare), words),
            share(per_word_row(ends), words),
        ]
    )


def features(docs: DataFrame) -> DataFrame:
    """``docs`` with an array column ``f`` instead of ``text``; other columns pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = utf8_column(batch["text"])
            rest = batch.drop_columns(["text"])
            for first, last in slices(bounds):
                f = statistics(data, bounds, first, last)
                offsets = pa.array(np.arange(len(f) + 1) * f.shape[1], pa.int32())
                part = rest.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(offsets, pa.array(f.ravel()))], names=[*part.schema.names, "f"])

    out = docs.drop("text").withColumn("f", F.array(F.lit(0.0))).schema
    return docs.mapInArrow(run, out)


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors, log determinants and log priors of the classes 0 and 1."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    offsets: list[float]
    constant: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        logs = [o - 0.5 * (((x - m) @ c.T) ** 2).sum(axis=1) for m, c, o in zip(self.means, self.factors, self.offsets)]
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(rows: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant:
    """From all rows of (f, label)."""
    d = len(FEATURES)
    products = [F.sum(F.element_at("f", i + 1) * F.element_at("f", j + 1)) for i in range(d) for j in range(i + 1)]
    sums = rows.groupBy("label").agg(F.count(F.lit(1)), F.array(*[F.sum(F.element_at("f", i + 1)) for i in range(d)]), F.array(*products))
    # Two rows at most.
    found = {int(label): (n, np.array(s), np.array(p)) for label, n, s, p in sums.collect()}
    if set(found) != {0, 1} or min(found[0][0], found[1][0]) < 2:
        total = sum(n for n, _, _ in found.values())
        return Discriminant([], [], [], found.get(1, (0,))[0] / total if total else 0.5)
    total, means, factors, offsets = found[0][0] + found[1][0], [], [], []
    for label in (0, 1):
        n, s, p = found[label]
        mean = s / n
        second = np.zeros((d, d))
        second[np.tril_indices(d)] = p / n
        second = second + np.tril(second, -1).T
        cov = second - np.outer(mean, mean)
        cov = (1 - shrinkage) * cov + shrinkage * np.diag(np.diag(cov)) + RIDGE * np.eye(d)
        lower = np.linalg.cholesky(cov)
        means.append(mean)
        factors.append(np.linalg.inv(lower))
        offsets.append(float(np.log(n / total) - np.log(np.diag(lower)).sum()))
    return Discriminant(means, factors, offsets)


def held_out(doc_id: str = "doc_id", folds: int = FOLDS) -> Column:
    return F.coalesce(crc32_text(doc_id) % folds == 0, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant:
    """The model from all labelled rows that are not held out."""
    marks = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("label"))
    source = docs.where(~held_out()).select("doc_id", F.col("text").cast("string").alias("text"))
    measured = stage(features(source), "statistics")
    return fit(measured.join(marks, "doc_id").select("f", "label"), shrinkage)


def scored(docs: DataFrame, model: Discriminant) -> DataFrame:
    """``docs`` with a column ``score``; texts are measured where they are and never shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = utf8_column(batch["text"])
            for first, last in slices(bounds):
                part = batch.slice(first, last - first)
                score = model.score(statistics(data, bounds, first, last))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], names=[*part.schema.names, "score"])

    return docs.mapInArrow(run, docs.drop("score").withColumn("score", F.lit(0.0)).schema) if "score" not in docs.columns else scored(docs.drop("score"), model)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, shrinkage: float = SHRINKAGE) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    model = fitted(docs, labels, shrinkage)
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    found = scored(source, model)
    return found.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    found = classify(read(spark, folder, "documents"), read(spark, folder, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")
