"""A corpus pipeline over `documents`: each stage calls one operator, is
written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentio.llm import bpe, decontaminate, language_id, line_dedup, simhash
from retentio.llm.common import table
from retentio.llm.tokenizer_files import tokenizer_path
from retentio.plans.tables import materialize


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told (`und` goes); one without a lang
    gets the predicted one."""
    return language_id.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows are cut out of the texts;
    n_chars follows the text. Every document stays."""
    out = line_dedup.dedup_lines(docs, removed=None)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, and the token ids of what is left."""
    out = bpe.encode_documents(docs, tokenizer_path())
    return out.select("doc_id", "lang", "source",
                      F.expr("octet_length(token_ids) div 4").cast("long").alias("n_tokens"),
                      "token_ids", F.sha2("token_ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded_text").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identify_languages),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("bpe_encoding", encode),
]

# Fingerprints, fitted machines and merges are beyond SQL: tests compare
# run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
