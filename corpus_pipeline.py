"""From raw documents to packed training sequences, in five stages.

Each stage gets all rows its predecessor kept, is written as Parquet in the shared
folder, and read back for the next one. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsmine.llm import exact, jaccard, packing, quality, suffixes
from newsmine.llm.common import documents, stored

#: Repeated passages of over 50 words are to be cut; 51 words of 3.9 bytes with their blank reach 200 bytes.
WINDOW = 200


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut failed lines out of the texts; rejected documents go."""
    return quality.cleaned(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest doc_id stays."""
    return exact.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a similarity of 0.8 on five-word shingles, the smallest doc_id stays."""
    return jaccard.deduplicated(docs, jaccard.Sets(words=5, percent=80))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut byte strings of ``WINDOW`` that start anywhere else out of the texts."""
    return suffixes.deduplicated(docs, WINDOW)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: bin, place and length in UTF-8 bytes."""
    return packing.packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot state repeated byte strings of any alignment or best-fit packing over whole tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
