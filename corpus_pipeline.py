"""From raw documents to packed training sequences, in five stages.

Each stage reads what the one before has kept and is written as Parquet before the next one starts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerstar.llm import exact, mixing, neardup, packing, quality
from ledgerstar.llm.tables import Tables


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in their language's band of perplexity."""
    return quality.accepted(docs, Tables(spark, "quality"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact.dedup(docs, Tables(spark, "exact"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: five words, similarity 0.8."""
    return neardup.dedup(docs, Tables(spark, "near"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their targets."""
    return mixing.mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of 1024 tokens."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(docs, Tables(spark, "packing"), path, keep_ids=False).drop("ids")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources", source_mix),
    ("best-fit packing", best_fit_packing),
]

# The language model, the similarity join and the packing are beyond SQL; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the packed pieces."""
    tables = Tables(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = tables.save(stage(spark, docs, sf_dir), f"stage{i}")
        if i:
            tables.drop(f"stage{i - 1}")
    return docs
