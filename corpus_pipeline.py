"""The corpus pipeline: five stages from documents to packed sequences.

Each stage takes what its predecessor kept and returns a DataFrame; ``run`` writes it below the
shared folder and hands the written table on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import exact_dedup, mixing, packing, quality, simhash
from riskloom.llm.common import table
from riskloom.llm.queries import WORD_BPE
from riskloom.session import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.deduplicate(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, WORD_BPE)


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", distinct_texts),
    ("simhash near-dedup", no_near_copies),
    ("source mixing", mixed_sources),
    ("best-fit packing", packed),
]

# The stages learn a model, hash with XXH64 and run a tokenizer: none of it has a SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir))
    return docs
