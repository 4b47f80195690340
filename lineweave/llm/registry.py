"""Queries of the training-data operators, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import embedding_dedup, exact_dedup, jaccard_join, language_id, line_dedup, mixing, packing, quality, secret_scan, warc_index


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": language_id.op1_language_id,
        "op2_quality_classifier": quality.op2_quality_classifier,
        "op3_line_dedup": line_dedup.op3_line_dedup,
        "op4_best_fit_packing": packing.op4_best_fit_packing,
        "op5_secret_scan": secret_scan.op5_secret_scan,
        "op6_warc_index": warc_index.op6_warc_index,
        "op7_ngram_jaccard_join": jaccard_join.op7_ngram_jaccard_join,
        "op8_exact_dedup": exact_dedup.op8_exact_dedup,
        "op9_source_mixing": mixing.op9_source_mixing,
        "op10_embedding_near_dedup": embedding_dedup.op10_embedding_near_dedup,
        "secret_patterns": secret_scan.secret_patterns,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_line_dedup": line_dedup.OP3_SQL,
        "secret_patterns": secret_scan.SECRET_PATTERNS_SQL,
        "op6_warc_index": warc_index.OP6_SQL,
        "op7_ngram_jaccard_join": jaccard_join.OP7_SQL,
        "op8_exact_dedup": exact_dedup.OP8_SQL,
        "op9_source_mixing": mixing.OP9_SQL,
        "op10_embedding_near_dedup": embedding_dedup.OP10_SQL,
    }
