"""A corpus pipeline: language, exact copies, near copies, source mix, packed batches.

Each stage takes the documents its predecessor kept and is written to the shared
folder before the next one reads it.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm import exact_dedup, langid, mixing, packing, simhash_wide
from shelfcast.llm.common import documents, store


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model accepts."""
    return langid.keep_once(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: close fingerprints, five-word similarity of 0.8 or more."""
    return simhash_wide.drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of each document in a bucket and batch."""
    return packing.packed(docs)


STAGES = [
    ("language", language), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixture), ("packing", batches),
]

# The language model and the fingerprints are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
