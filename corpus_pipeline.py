"""The corpus pipeline: documents through quality rules, line dedup, near-copy removal,
benchmark decontamination and piece encoding.  Each stage's rows are written as Parquet and
read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyvault.llm import decontamination, jaccard_join, line_dedup, quality_rules, sentencepieces
from tallyvault.llm.common import documents, stored
from tallyvault.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are mostly boilerplate of their host go."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines found in many documents only the first occurrence stays; emptied documents go."""
    return line_dedup.drop_frequent_lines(docs, keep="first")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 5-word shingle sets of Jaccard similarity 0.8 or more, the first stays."""
    return jaccard_join.one_of_each(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage like a benchmark item go."""
    return decontamination.without_leaks(docs, documents(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded text."""
    return sentencepieces.encode_and_decode(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", leaks),
    ("SentencePiece encoding and decoding", pieces),
]

ORACLE_SQL = None  # SQL can't express the later stages; tests/llm holds run() against a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
