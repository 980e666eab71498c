"""The corpus pipeline: five operators in a row over the documents table.

Each stage reads what its predecessor wrote.  All but the last return the columns of documents.

A null or empty text fails the quality rules and is gone after them, as is every text of fewer than ten words; a null
lang or source is a value of its own.  Repeated rows and null ids go through all stages: rows equal in id and text lose the
same lines, and one of them stays after the n-gram join.  Very long texts are worked on whole.  An empty table stays
empty.  Further columns stay as they are up to the mix; the last stage returns the token columns alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkwell.llm import bpe, lines, mixing, quality, similar
from inkwell.llm.common import discard, documents, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the rules reject go."""
    return quality.quality_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: repeated and nearly repeated lines go, their first occurrence stays."""
    return lines.dedup_lines(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each group of near copies stays."""
    return similar.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: every document as often as its source's target takes it."""
    return mixing.mixed_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: token counts and digests of ids and of the text decoded from them."""
    return bpe.round_trip(docs, bpe.vocabulary())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("mix_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]

#: Fuzzy line dedup and the encoding are not SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each is written as Parquet and read again by the next."""
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if k:
            discard(before)
    return docs
