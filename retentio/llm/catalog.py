"""The queries of the training-data operators, and their SQL."""

from __future__ import annotations

import corpus_pipeline

from . import (bpe, decontaminate, exact_dedup, hard_negatives, html_extract, importance,
               language_id, license_scan, line_dedup, simhash, token_counts, token_files, url_filter)
from .common import table
from .tokenizer_files import tokenizer_path

QUERIES = {
    "op1_bpe": lambda spark, d: bpe.digest_query(table(spark, d, "documents"), tokenizer_path()),
    "op2_token_counts": lambda spark, d: token_counts.count_query(
        table(spark, d, "documents"), tokenizer_path()),
    "op3_line_dedup": lambda spark, d: line_dedup.line_query(table(spark, d, "documents")),
    "op4_simhash": lambda spark, d: simhash.simhash_query(table(spark, d, "documents")),
    "op5_license_scan": lambda spark, d: license_scan.license_query(table(spark, d, "documents")),
    "op6_language_id": lambda spark, d: language_id.language_query(table(spark, d, "documents")),
    "op7_exact_dedup": lambda spark, d: exact_dedup.exact_query(table(spark, d, "documents")),
    "op8_html_extract": lambda spark, d: html_extract.html_query(table(spark, d, "pages")),
    "op9_decontamination": lambda spark, d: decontaminate.contamination_query(
        table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op10_url_filter": lambda spark, d: url_filter.url_query(table(spark, d, "pages")),
    "op11_hard_negatives": lambda spark, d: hard_negatives.hard_negative_query(
        table(spark, d, "embeddings")),
    "op12_importance_resampling": lambda spark, d: importance.importance_query(
        table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op13_token_files": lambda spark, d: token_files.token_file_query(
        table(spark, d, "documents"), tokenizer_path()),
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op3_line_dedup": line_dedup.LINE_SQL,
    "op7_exact_dedup": exact_dedup.EXACT_SQL,
    "op10_url_filter": url_filter.URL_SQL,
    "op12_importance_resampling": importance.IMPORTANCE_SQL,
}
