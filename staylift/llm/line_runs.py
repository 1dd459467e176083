"""Repeated lines by levelled sorted runs of line hashes, as a store that grows batch by batch."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylift.llm.shared import ascii_lower, checkpointed, trimmed

KEY = ["k1", "k2"]


def key_hashes(key: Column) -> list[Column]:
    """A line key's 128-bit hash as two longs."""
    return [F.xxhash64(key).alias("k1"), F.xxhash64(F.lit(1), key).alias("k2")]


def line_keys(text: Column) -> Column:
    """The keys of a text's lines in order: A-Z lower-cased, white space stripped at both ends; one empty line for null."""
    return F.transform(F.split(ascii_lower(F.coalesce(text, F.lit(""))), "\n"), trimmed)


def document_counts(docs: DataFrame) -> DataFrame:
    """In how many rows of ``docs`` each line key of one code point or more occurs: k1, k2, docs."""
    keys = docs.select(line_keys(F.col("text")).alias("keys")).select(F.explode(F.array_distinct("keys")).alias("key"))
    return keys.filter("key != ''").select(*key_hashes(F.col("key"))).groupBy(*KEY).agg(F.count("*").alias("docs"))


class LineRuns:
    """Runs of (line hash, documents), each a table bucketed and sorted by hash, in levels of ``fanout`` runs.

    A key is settled once a single run counts it in ``settled_at`` documents; batches added later leave it out. With
    ``settled_at=1`` every known line is settled, and what a batch adds are the lines that no earlier batch had.
    A full level is merged into one run of the next, so that n batches leave about fanout * log(n) runs.
    """

    def __init__(self, spark: SparkSession, settled_at: int = 1, fanout: int = 4, buckets: int | None = None):
        self.spark, self.settled_at, self.fanout = spark, settled_at, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self._label = f"line_run_{uuid.uuid4().hex}"
        self._written = 0

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def unsettled(self, counts: DataFrame) -> DataFrame:
        """The batch without settled keys: a merge anti join with every run, none of which is shuffled for it."""
        for name in self.runs():
            settled = self.spark.table(name).filter(F.col("docs") >= self.settled_at).select(*KEY)
            counts = counts.join(settled.hint("merge"), KEY, "left_anti")
        return counts

    def add(self, docs: DataFrame) -> None:
        """Take in a batch of documents."""
        self._put(0, self.unsettled(document_counts(docs)))

    def _put(self, level: int, rows: DataFrame) -> None:
        name = f"{self._label}_{self._written}"
        self._written += 1
        dealt = rows.repartition(self.buckets, *KEY)
        dealt.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).format("parquet").saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._merged(full))
            self._remove(full)

    def _merged(self, names: list[str]) -> DataFrame:
        # One scan of their folders: a union of the bucketed tables was aggregated without a shuffle, though not read by bucket,
        # and left a key's counts apart.
        folders = [self.spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first().data_type for name in names]
        rows = self.spark.read.schema(self.spark.table(names[0]).schema).parquet(*folders)
        return rows.groupBy(*KEY).agg(F.sum("docs").alias("docs"))

    def frequent(self, min_docs: int) -> DataFrame:
        """Keys in ``min_docs`` documents or more, over all batches: k1, k2. ``min_docs`` may not exceed ``settled_at``."""
        if min_docs > self.settled_at:
            raise ValueError("keys are no longer counted once settled")
        if not self.runs():
            return self.spark.createDataFrame([], "k1 LONG, k2 LONG")
        return self._merged(self.runs()).filter(F.col("docs") >= min_docs).select(*KEY)

    def _remove(self, names: Iterable[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def close(self) -> None:
        self._remove(self.runs())
        self.levels = []


def file_batches(spark: SparkSession, path: str, batches: int) -> list[DataFrame]:
    """A Parquet table as at most ``batches`` tables, each file in one of them; one with fewer files than that is cut
    into exactly ``batches`` by a hash of doc_id and text. Other columns are of any type; rows equal in both go together."""
    whole = spark.read.parquet(path)
    files = sorted(whole.inputFiles())
    if len(files) < batches:
        turn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches))
        return [whole.filter(turn == i) for i in range(batches)]
    size = math.ceil(len(files) / batches)
    return [spark.read.schema(whole.schema).parquet(*files[i : i + size]) for i in range(0, len(files), size)]


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    for batch in batches:
        n_lines, n_dropped, kept = [], [], []
        for text, dropped in zip(batch["text"].to_pylist(), batch["dropped"].to_pylist(), strict=True):
            lines, gone = (text or "").split("\n"), set(dropped or ())
            n_lines.append(len(lines))
            n_dropped.append(len(gone))
            kept.append("\n".join(line for i, line in enumerate(lines) if i not in gone) if gone else text or "")
        yield pa.RecordBatch.from_arrays(
            [batch["record"], pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())],
            ["record", "n_lines", "n_dropped", "kept"],
        )


def without_lines(docs: DataFrame, frequent: DataFrame) -> DataFrame:
    """Cut every line whose key is listed: record (all of the row but its text), n_lines (before), n_dropped, kept (text).

    Line hashes are exploded with their places and semi-joined with the list; a document's hits come back as a set of
    places, never more than it has lines. Null and empty texts have one empty line, which is never cut.
    """
    spark = docs.sparkSession
    marks = [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2")]
    rows = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("record"))
    # The key's row is what decides the cut: equal texts of one doc_id share it, others meet only in their lines.
    rows = rows.select("*", F.col("record.doc_id").alias("id"), *marks)
    lines = rows.select("id", "t1", "t2", F.posexplode(line_keys(F.col("text"))).alias("place", "key")).filter("key != ''")
    hits = lines.select("id", "t1", "t2", "place", *key_hashes(F.col("key"))).join(frequent, KEY, "left_semi")
    hits = hits.groupBy("id", "t1", "t2").agg(F.collect_set("place").alias("dropped"))
    hits = hits.select(F.col("id").alias("hit"), F.col("t1").alias("h1"), F.col("t2").alias("h2"), "dropped")
    same = rows["id"].eqNullSafe(hits["hit"]) & (rows["t1"] == hits["h1"]) & (rows["t2"] == hits["h2"])
    found = rows.join(hits, same, "left").select("record", "text", "dropped")
    record = found.schema["record"].dataType.simpleString()
    return found.mapInArrow(_cut, f"record {record}, n_lines LONG, n_dropped LONG, kept STRING")


def drop_repeated_lines(batches: list[DataFrame], min_docs: int = 10, fanout: int = 3) -> DataFrame:
    """Documents without the lines whose key occurs in ``min_docs`` documents or more of all batches together.

    Batches are taken in one after the other; then all of them are cut by the keys that ended up frequent. Columns:
    record (the row without its text), n_lines, n_dropped, kept. Rows that repeat count as documents of their own; a
    line that repeats within a document counts once. An empty table gives no rows.
    """
    spark = batches[0].sparkSession
    runs = LineRuns(spark, settled_at=min_docs, fanout=fanout)
    try:
        for batch in batches:
            runs.add(batch.select("text"))
        frequent = checkpointed(runs.frequent(min_docs))
    finally:
        runs.close()
    docs = batches[0]
    for batch in batches[1:]:
        docs = docs.unionByName(batch)
    return without_lines(docs, frequent)
