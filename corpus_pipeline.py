"""The corpus pipeline: language, quality, shared lines, near-duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it kept; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from probelake.llm import language_id, line_dedup, near_dups, packing, quality
from probelake.llm.common import table, tokenizer_file
from probelake.session import staged

CAPACITY = 4096


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identifiable language go."""
    return language_id.keep_identified(docs).select(*docs.columns)


def judge_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go."""
    return quality.keep_good(docs).select(*docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in at least ten of the documents go."""
    return line_dedup.drop_common_lines(docs, min_docs=10, min_chars=1).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, similarity of 0.8."""
    return near_dups.keep_one_of_each(docs, n=5, percent=80).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, as pieces of sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_file(), CAPACITY, with_ids=False)


STAGES = [
    ("language_id", identify_language),
    ("quality", judge_quality),
    ("line_dedup", drop_shared_lines),
    ("near_dups", drop_near_duplicates),
    ("packing", pack_sequences),
]

#: Learning and packing have no SQL counterpart; the tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that the stages keep; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"stage-{name}")
    return docs
