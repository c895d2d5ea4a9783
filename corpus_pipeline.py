"""Documents to packed training sequences: language, quality, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the columns of documents; the last returns the pieces of the
packed sequences. What a stage returns is written to the shared folder and read again as the next one's input, so a lost executor
costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from faultline.llm import langid, minhash, mixing, packing, quality
from faultline.llm.common import saved, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have no letter or whose language is not clear."""
    return langid.known(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that the labelled neighbours vote down."""
    return quality.good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.distinct_documents(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in sequences of tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", language),
    ("quality classifier", good_quality),
    ("MinHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mixed),
    ("best-fit packing", packed),
]

#: Trained models decide what two stages keep, which SQL cannot express; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, last: Callable[[SparkSession, DataFrame, str], DataFrame] = packed) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1], 1):
        docs = saved(stage(spark, docs, sf_dir), f"stage-{number}")
    return last(spark, docs, sf_dir)


def training_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of each packed sequence, where run() returns the places of the pieces."""
    return run(spark, sf_dir, lambda spark, docs, sf_dir: packing.sequences(docs))
