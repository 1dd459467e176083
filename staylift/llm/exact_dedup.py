"""Exact duplicates by skew-safe combining: per salted digest group, then across the salts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylift.llm.shared import ascii_lower, checkpointed, other_columns
from staylift.operators.membership import Bloom, bloom


def text_digest(norm: Column) -> Column:
    return F.sha2(norm.cast("binary"), 256)


def normalised(text: Column) -> Column:
    """The text as it is compared: A-Z lower-cased, null as empty."""
    return ascii_lower(F.coalesce(text, F.lit("")))


def _with_digest(docs: DataFrame, digest, salts: int, *more: Column) -> DataFrame:
    """Documents with their normalised text, ``norm``, its digest, which is never null, and a salt.

    The salt is that of the task that reads the document, drawn before any shuffle, after which all rows of a digest
    would have the same. Who needs the normalised text takes it from here: made again, it would cost each task a second
    Python worker beside the digest's.
    """
    read = docs.select("doc_id", "text", *more, normalised(F.col("text")).alias("norm"))
    return read.withColumns({"digest": F.coalesce(digest(F.col("norm")), F.lit("")), "salt": F.spark_partition_id() % salts})


def twin_filter(rows: DataFrame) -> Bloom:
    """A filter of the digests of more than one row. No text is moved: digests are counted, and combine map-side.

    What the filter turns away differs from all others and needs no comparison; what it lets through by mistake is compared
    for nothing.
    """
    counts = rows.groupBy("digest").agg(F.count("*").alias("n"))
    return bloom(counts.filter("n > 1").select("digest"), "digest")


def copy_groups(rows: DataFrame) -> DataFrame:
    """A row per distinct normalised text of ``rows`` (doc_id, norm, digest, salt): digest, keep_id (largest doc_id), group_size, norm.

    Three combining stages, each grouping on the content itself and not on its digest alone: the rows of a task, before
    anything is shuffled; what the tasks of one salt have of a digest; and the salts' winners of a digest.

    ``norm`` is null unless two texts share the digest; then the content has to tell their rows apart.
    """
    shares = rows.groupBy("digest", "salt", "norm")
    winners = shares.agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))
    whole = winners.groupBy("digest", "norm").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    shared = F.count("*").over(Window.partitionBy("digest")) > 1
    return checkpointed(whole.select("digest", "keep_id", "group_size", F.when(shared, F.col("norm")).alias("norm")))


def mark_copies(docs: DataFrame, salts: int = 32, digest=text_digest) -> DataFrame:
    """Every document with its group: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as the empty text. The row with the largest
    doc_id stays; a null doc_id is smaller than any. Rows that repeat both doc_id and text are one document and carry
    the same flags. Other columns are not read. An empty table gives no rows.

    Text that no other row has is read and never moved; of copies each task sends one. Rows meet their group by digest and
    salt, so that a text that a third of all rows have is dealt over as many tasks as there are salts.
    """
    read = _with_digest(docs.select("doc_id", "text"), digest, salts)
    rows = checkpointed(read.drop("text", "norm"))
    likely = twin_filter(rows)
    groups = copy_groups(read.filter(likely.may_hold(F.col("digest"))))
    suspects, names = rows.filter(likely.may_hold(F.col("digest"))), ["digest", "salt"]
    if not groups.filter("norm IS NOT NULL").isEmpty():
        # Some digest has two contents: from here on the content is part of what names a text with such a digest.
        clashing = groups.filter("norm IS NOT NULL").select("digest", F.lit(True).alias("clash")).distinct()
        again = read.filter(likely.may_hold(F.col("digest"))).join(clashing, "digest", "left")
        suspects = again.withColumn("norm", F.when(F.col("clash"), F.col("norm")).otherwise("")).drop("clash", "text")
        groups, names = groups.withColumn("norm", F.coalesce("norm", F.lit(""))), [*names, "norm"]
    else:
        groups = groups.drop("norm")
    dealt = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    found = suspects.join(dealt, names).select("doc_id", "keep_id", "group_size", "digest")
    alone = rows.filter(~likely.may_hold(F.col("digest"))).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "digest")
    return found.unionByName(alone).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256")
    )


def drop_copies(docs: DataFrame, salts: int = 32, digest=text_digest) -> DataFrame:
    """One document of every group of equal texts, with all columns of ``docs`` whatever their names.

    The rule is that of ``mark_copies``, with the same stages, which here carry the winners' whole rows; of rows that tie in
    doc_id the one whose other columns, as JSON, and then text come last stays. Documents whose digest no other has go
    through untouched and are not shuffled. An empty table gives no rows.
    """
    packed = _with_digest(docs, digest, salts, F.struct("*").alias("whole")).drop("text")
    likely = twin_filter(packed)
    alone = packed.filter(~likely.may_hold(F.col("digest"))).select("whole.*")
    copied = packed.filter(likely.may_hold(F.col("digest")))
    last = F.max_by("whole", F.struct("whole.doc_id", other_columns(docs, "whole"), "whole.text")).alias("whole")
    shares = copied.groupBy("digest", "salt", "norm").agg(last)
    winners = shares.groupBy("digest", "norm").agg(last)
    return alone.unionByName(winners.select("whole.*"))
