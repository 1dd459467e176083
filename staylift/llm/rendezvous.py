"""Shards by weighted rendezvous hashing of stable record keys."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylift.llm.shared import checkpointed, running_total


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the highest score for a key: -weight / ln(u), u drawn in (0, 1) from a hash of shard and key.

    A key's score on a shard depends on nothing else, so that one more shard takes keys from every other in proportion
    to the weights and moves no key between the others. Equal scores: the smaller shard. Null keys share one place.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("shards need positive weights")
    best = None
    for shard, weight in enumerate(weights):
        digits = F.substring(F.md5(F.concat(F.lit(f"{shard}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary")), 1, 13)
        drawn = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(math.ldexp(1, 52))
        score = F.struct((F.lit(-float(weight)) / F.log(drawn)).alias("score"), F.lit(-shard).alias("back"))
        best = score if best is None else F.greatest(best, score)
    return (-best["back"]).cast("int")


def with_shards(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, key: str = "doc_id") -> DataFrame:
    """All columns of ``docs`` after ``shard`` and, where ``grown`` weights are given, ``grown_shard``."""
    more = [shard_of(F.col(key), grown).alias("grown_shard")] if grown else []
    return docs.select(shard_of(F.col(key), weights).alias("shard"), *more, F.struct("*").alias("record"))


def shard_table(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Where each document goes: doc_id, size, text_crc32, shard, slot, grown_shard (with one more shard).

    size is the text's UTF-8 bytes plus one; a null text has no bytes and the checksum of none. slot numbers a shard's
    rows from 0 without gaps, by doc_id (null first), checksum and size; rows that repeat all three follow each
    other. Rows of one doc_id always share a shard, since the key alone decides. Other columns are not read.
    """
    placed = with_shards(docs.select("doc_id", "text"), [1.0] * shards, [1.0] * (shards + 1))
    raw = F.coalesce(F.col("record.text"), F.lit("")).cast("binary")
    rows = placed.select(
        F.col("record.doc_id").alias("doc_id"), (F.length(raw) + F.lit(1)).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), "shard", "grown_shard",
    )
    return running_total(checkpointed(rows), ["shard"], ["doc_id", "text_crc32", "size"], F.lit(1), "slot")
