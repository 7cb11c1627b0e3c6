"""Documents through language ID, quality rules, near duplicates and packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martloom.llm import language, ngram_join, packing, quality_rules
from martloom.llm.common import in_large_files, table, text_crc
from martloom.workspace import stage

# SQL has neither the language model nor the search for the tightest compatible bin; the stages are
# tested against brute-force versions.
ORACLE_SQL = None


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which one learned language holds at least ``language.LEAST`` of the letters, and of which
    learned languages explain at least ``language.EXPLAINED``.

    The model learns from all documents of the stage that it may learn from; language labels are used for nothing else.
    """
    model = language.fit(docs, text_crc("doc_id") % 4 != 2, max_docs=None)
    return in_large_files(language.keep(docs, model), docs)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and all certified cutoffs of their language."""
    return in_large_files(quality_rules.keep(docs, table(spark, sf_dir, "labels")), docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group linked by five-word shingles at a similarity of 0.8."""
    return in_large_files(ngram_join.keep_one(docs, k=5, percent=80), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and the bins that they are packed into."""
    return packing.pack(docs)


STAGES = [
    ("language", keep_known_language),
    ("quality", keep_quality),
    ("near_copies", keep_one_of_near_copies),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, name)
    return docs
