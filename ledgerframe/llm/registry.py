"""The queries of the corpus operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerframe.llm import centroids, decontaminate, exact_dedup, language_id, line_dedup, lm_scoring, media_ogg, mixing, prefix_trie, secret_scan, sharding, simhash, substring_dedup


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": substring_dedup.op1,
        "op2_line_dedup": line_dedup.op2,
        "op3_lm_scoring": lm_scoring.op3,
        "op4_sharding": sharding.op4,
        "op5_simhash_neardup": simhash.op5,
        "op6_language_id": language_id.op6,
        "op7_ogg_media": media_ogg.op7,
        "op8_secret_scan": secret_scan.op8,
        "op9_decontamination": decontaminate.op9,
        "op10_mixing": mixing.op10,
        "op11_prefix_trie": prefix_trie.op11,
        "op12_centroids": centroids.op12,
        "op13_exact_dedup": exact_dedup.op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op8_secret_scan": secret_scan.OP8_SQL,
        "op9_decontamination": decontaminate.OP9_SQL,
        "op10_mixing": mixing.OP10_SQL,
        "op11_prefix_trie": prefix_trie.OP11_SQL,
        "op12_centroids": centroids.OP12_SQL,
        "op13_exact_dedup": exact_dedup.OP13_SQL,
    }
