"""The corpus pipeline: five stages over ``documents``, each written and read again.

For all stages: rows are told apart by where they are stored, so null and
repeated ids lose and multiply nothing; texts are read whole, however long;
extra columns come through unchanged, whatever their names, in all but the last
stage, and null values in them mean nothing; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayfare.llm import minhash, mixing, packing, quality, suffix_dedup
from wayfare.llm.common import Scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule.

    Null and empty texts have no words and go; repeated rows get one verdict.
    """
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8): that with the smallest id, a null id being the largest.

    Documents without words are in no group and stay; of repeated rows, as of
    rows that share an id and a group, one stays.
    """
    return minhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document before them has; a document of which nothing is left goes.

    Null and empty texts lose nothing and stay; a null id counts as larger than
    all ids, and rows that share an id take nothing from each other.
    """
    return suffix_dedup.without_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents any of whose words the mix takes, whole, once per epoch, in the order of its slots.

    A null source is a source like others, the last one; null and empty texts
    have no words to take and go.
    """
    return mixing.mixed_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1,024 tokens.

    Null and empty texts are their end token; repeated rows are documents each.
    """
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("source mix", source_mix),
    ("packing", sequences),
]

#: Tokenization can't be written in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a table in the shared folder."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.put(stage(spark, docs, sf_dir), f"stage{k}")
        if k:
            scratch.drop(f"stage{k - 1}")
    return docs
