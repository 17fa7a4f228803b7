"""A corpus pipeline: judge, remove near copies, remove repeated passages, pseudonymise, pack.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept, and returns a DataFrame that is
written as Parquet and read again as the next one's docs.  All but the last return the columns of ``documents``; extra
columns pass through, whatever their names.  An empty table gives an empty result at every stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from timelane.llm import best_fit, minhash_join, pii, quality, substring_dedup
from timelane.llm.common import read, row_key, stage


def safe_names(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``docs`` with names of its extra columns that no operator uses, and the columns that give the old names back."""
    names = [c if c in ("doc_id", "text") else f"__column{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), [F.col(n).alias(c) for n, c in zip(names, docs.columns)]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on their labels, does not reject.

    Null and empty texts are judged by their score like any other; repeated rows are judged alike.  Without labels of
    both classes nothing is rejected by chance: every score is the same.
    """
    model = quality.fitted(docs, read(spark, sf_dir, "labels"))
    safe, back = safe_names(docs)
    return quality.scored(safe, model).where(F.col("score") >= quality.THRESHOLD).select(*back)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; of repeated rows the first by their other columns.

    Rows without a doc_id repeat nothing: each of them stays.  Null and empty texts are no copies of each other.
    """
    kept = minhash_join.near_duplicates(docs).where("kept").select(F.col("k").alias("__k")).distinct()
    safe, back = safe_names(docs)
    marked = safe.withColumn("__k", row_key("doc_id", "text")).withColumn("__lone", F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()))
    others = [c for c in safe.columns if c not in ("doc_id", "text")]
    first = F.min_by(F.struct(*safe.columns), F.to_json(F.struct(*others)) if others else F.lit(""))
    return marked.join(kept, "__k").groupBy("__k", "__lone").agg(first.alias("__row")).select("__row.*").select(*back)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages; a document that loses all its words goes.

    Null, empty and unchanged texts stay as they are, and so do rows without a doc_id; repeated rows lose the same words.
    """
    found = substring_dedup.substring_dedup(docs).where("n_removed > 0")
    changed = found.groupBy(F.col("k").alias("__k")).agg(F.max("kept").alias("__kept"), F.max(F.col("n_removed") == F.col("n_words")).alias("__gone"))
    safe, back = safe_names(docs)
    joined = safe.withColumn("__k", row_key("doc_id", "text")).join(changed, "__k", "left").where(~F.coalesce("__gone", F.lit(False)))
    return counted(joined.withColumn("text", F.coalesce("__kept", "text")).select(*back))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms in place of personal data, equal ones for equal values; null texts stay null."""
    safe, back = safe_names(docs)
    return counted(safe.withColumn("text", pii.masked(F.col("text"))).select(*back))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their sequences; a null or empty text is one piece, repeated rows are packed each."""
    return best_fit.pack(docs)


def counted(docs: DataFrame) -> DataFrame:
    """``docs`` with the length of the text as it is now."""
    return docs.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else docs


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("substring dedup", substring_stage),
    ("PII", pii_stage),
    ("best-fit packing", packing_stage),
]

#: Classifier, Feistel network and tokenizer are no SQL; the tests restate each stage in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), "pipeline")
    return docs
