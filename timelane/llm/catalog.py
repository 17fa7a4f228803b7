"""The registered queries of this subpackage and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from timelane.llm import (
    best_fit,
    byte_bpe,
    centroid_clusters,
    embedding_lsh,
    html_text,
    line_dedup,
    minhash_join,
    periodic_runs,
    permutation_index,
    pii,
    quality,
    substring_dedup,
    toxicity,
)

MODULES = {
    "op1_substring_dedup": substring_dedup,
    "op2_embedding_near_dedup": embedding_lsh,
    "op3_toxicity": toxicity,
    "op4_best_fit_packing": best_fit,
    "op5_nearest_neighbours": permutation_index,
    "op6_quality_classifier": quality,
    "op7_minhash_near_dedup": minhash_join,
    "op8_html_extraction": html_text,
    "op9_pii_pseudonyms": pii,
    "op10_byte_bpe": byte_bpe,
    "op11_periodic_runs": periodic_runs,
    "op12_centroid_clusters": centroid_clusters,
    "op13_line_dedup": line_dedup,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: module.query for name, module in MODULES.items()}


def checks() -> dict[str, str]:
    return {name: module.ORACLE_SQL for name, module in MODULES.items() if hasattr(module, "ORACLE_SQL")}
