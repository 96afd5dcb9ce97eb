"""From raw documents to token files: quality, near duplicates, decontamination, mix, tokens.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before has kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trendmark.llm import decontaminate, mixing, ngram_join, quality
from trendmark.llm.common import learning_row, stored, table
from trendmark.llm.queries import token_shards


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from labels of four ids in five."""
    labels = table(spark, sf_dir, "labels").filter(learning_row("doc_id", 5, 0))
    return quality.keep_accepted(docs, quality.learn(docs, labels))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group joined by n-gram Jaccard links."""
    return ngram_join.first_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark items."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the target mix of sources takes it."""
    return mixing.mix(docs)


def as_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, and what they hold of each."""
    return token_shards(docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", without_near_copies),
    ("decontamination", without_benchmark),
    ("mix", mixed),
    ("token_files", as_token_files),
]

#: A learned classifier and random rounding are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
