"""The registered queries of the corpus operators; ``oracles`` has the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from staylift.llm import (
    block_mixing, cost_packing, exact_dedup, gray_simhash, license_rules, line_runs, mcd_quality, merkle_manifest, pseudonyms,
    quantised_tiles, rendezvous, shallot, toxicity_gru,
)
from staylift.llm.oracles import SQL

__all__ = ["QUERIES", "SQL"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def pseudonymised_table(docs: DataFrame) -> DataFrame:
    # A registered query has no secret store at hand; a job passes a key of its own.
    return pseudonyms.pseudonymised(docs.select("doc_id", "text"), key="registered query")


@query
def op1_mcd_quality(spark: SparkSession, sf: str) -> DataFrame:
    return mcd_quality.judged(documents(spark, sf))


@query
def op2_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.mark_copies(documents(spark, sf))


@query
def op3_line_runs(spark: SparkSession, sf: str) -> DataFrame:
    batches = line_runs.file_batches(spark, f"{sf}/documents.parquet", 6)
    cut = line_runs.drop_repeated_lines([b.select("doc_id", "text") for b in batches], min_docs=10)
    return cut.select("record.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op4_gray_simhash(spark: SparkSession, sf: str) -> DataFrame:
    marked = gray_simhash.near_copies(documents(spark, sf), length=3, radius=2)
    return marked.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op5_feistel_pii(spark: SparkSession, sf: str) -> DataFrame:
    made = pseudonymised_table(documents(spark, sf))
    return made.select("record.doc_id", "text", *[f"n_{kind}" for kind in pseudonyms.KINDS])


@query
def op6_rendezvous(spark: SparkSession, sf: str) -> DataFrame:
    table = rendezvous.shard_table(documents(spark, sf), shards=8)
    return table.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op7_toxicity_gru(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    found = toxicity_gru.scored(docs, toxicity_gru.fitted(docs, labels))
    return found.select(
        "doc_id", toxicity_gru.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def packed_sequences(docs: DataFrame) -> DataFrame:
    pieces = cost_packing.packed(docs, cost_packing.byte_bpe(), capacity=1024)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op8_cost_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packed_sequences(documents(spark, sf))


@query
def op9_license_rules(spark: SparkSession, sf: str) -> DataFrame:
    found = license_rules.recognised(documents(spark, sf))
    return found.select(
        "doc_id", F.array_join("licences.name", " ").alias("licences"), F.array_join("sentences.name", " ").alias("sentences"),
        F.size("licences").cast("long").alias("n_licences"),
    )


@query
def op10_block_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return block_mixing.taken_words(documents(spark, sf), weights=(3, 1, 2), percent=150, cap=2, block_words=64)


@query
def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    made = merkle_manifest.manifest(docs, tampered, {"n_chars": F.col("n_chars") + 1})
    return made.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", "").cast("binary"), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/embeddings.parquet")


@query
def op12_quantised_tiles(spark: SparkSession, sf: str) -> DataFrame:
    return quantised_tiles.linked(embeddings(spark, sf), threshold=0.95)


@query
def op13_shallot(spark: SparkSession, sf: str) -> DataFrame:
    return shallot.clustered(embeddings(spark, sf), k=40, rounds=5, dims=64, scale=256, seed=2)


@query
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf)


if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
