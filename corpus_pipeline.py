"""From raw documents to packed training sequences: five stages, each written as a table and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staylift.llm import block_mixing, cost_packing, exact_dedup, gray_simhash, toxicity_gru
from staylift.sources.workspace import settle


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a network fitted on the table's labels does not find toxic."""
    model = toxicity_gru.fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity_gru.without_toxic(docs, model, threshold=0.7)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that of the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked, that of the smallest doc_id."""
    return gray_simhash.drop_near_copies(docs, length=3, radius=2)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources' documents at their target weights; what is taken twice is there twice."""
    return block_mixing.mixed_documents(docs, weights=(3, 1, 2), percent=150, cap=2, block_words=64)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 1024, their ids with them."""
    return cost_packing.packed(docs, cost_packing.byte_bpe(), capacity=1024)


STAGES = [
    ("toxicity", toxicity), ("exact dedup", exact_copies), ("SimHash near-dedup", near_copies),
    ("mixing sources to target weights", mixing), ("packing", packing),
]

#: A trained network and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result but the last is stored in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
