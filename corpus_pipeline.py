"""A corpus from raw documents to packed sequences: five stages, each written and read again.

Every stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marlstone.llm.exact import drop_copies
from marlstone.llm.minhash import drop_near_copies
from marlstone.llm.packing import cut_pieces, pack
from marlstone.llm.paragraphs import remove_repeated
from marlstone.llm.quality_rules import keep_good
from marlstone.llm.storage import keep

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the fixed limits or lie far from their language and source go."""
    return keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of similar texts stays."""
    return drop_near_copies(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages found in several documents stay in the first; ``n_chars`` of changed texts is counted anew."""
    return remove_repeated(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of encoded documents and their places in sequences of 2048 tokens."""
    return pack(cut_pieces(docs, VOCABULARY))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("best-fit packing", packing),
]

#: SQL cannot express the stages; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
