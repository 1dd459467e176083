"""Last-contact logs: who was shown or mailed when."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylift.sources.workspace import remove

# Log stamps carry a fixed +09:00 offset; the database clock is the same zone, so both become wall clock.
LOG_ZONE_EPOCH = "1970-01-01 09:00:00"


def wall_clock(iso: Column) -> Column:
    """ISO-8601 text with an offset -> wall clock at +09:00, whatever the session time zone."""
    micros = F.unix_micros(F.to_timestamp(iso))
    epoch = F.lit(LOG_ZONE_EPOCH).cast("timestamp_ntz")
    seconds = (micros.cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return epoch + F.make_dt_interval(secs=seconds)


def _log_schema(key: str, stamp: str, key_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(key, key_type), T.StructField(stamp, T.TimestampNTZType())])


def _missing(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (error.getCondition() or "")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table that may not have been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if _missing(e):
            return spark.createDataFrame([], schema)
        raise


#: An entry's value ends here; so does what a task reads, whatever byte it began at.
ENTRY_END = '",'


def _members(spark: SparkSession, path: str, root: str) -> DataFrame:
    """The log cut at the ends of its entries, each piece made an object of its own; null where a piece is none."""
    pieces = spark.read.text(path, lineSep=ENTRY_END)
    opening = r"^\s*\{\s*" + re.escape(json.dumps(root, ensure_ascii=False)) + r"\s*:\s*\{"
    text = F.regexp_replace(F.regexp_replace("value", opening, ""), r'"\s*\}\s*\}\s*$', "")
    # A log without entries, or what follows the last one.
    blank = F.regexp_replace(text, r"[\s}]", "") == ""
    member = F.concat(F.lit("{"), text, F.lit('"}'))
    return pieces.filter(~blank).select(F.when(F.try_parse_json(member).isNotNull(), member).alias("member"))


def read_contact_log(
    spark: SparkSession, path: str, root: str, key: str, stamp: str, key_type: T.DataType = T.StringType()
) -> DataFrame:
    """Import a JSON log ``{root: {key: iso stamp}}``, or a folder of them; a log that does not exist yet is empty.

    One log is read by as many tasks as its size asks for: it is taken as text that is cut at the ends of entries, so that
    each task begins at the next entry. Where that cannot be done (a key that holds a quote and a comma, or a root that is
    not the first and only member) the log is parsed whole, by one task per file. Once imported, contacts live in the
    table written by ``append_contacts``.
    """
    texts = T.MapType(T.StringType(), T.StringType())
    try:
        members = _members(spark, path, root)
    except AnalysisException as e:
        if _missing(e):
            return spark.createDataFrame([], _log_schema(key, stamp, key_type))
        raise
    if members.filter("member IS NULL").isEmpty():
        entries = members.select(F.explode(F.from_json("member", texts)).alias("k", "v"))
    else:
        log = spark.read.schema(T.StructType([T.StructField(root, texts)])).json(path, multiLine=True)
        entries = log.select(F.explode(F.col(root)).alias("k", "v"))
    return entries.select(F.col("k").cast(key_type).alias(key), wall_clock(F.col("v")).alias(stamp))


def merge_contacts(log: DataFrame, new: DataFrame, key: str, stamp: str) -> DataFrame:
    """Latest stamp per key. Order-free and idempotent, so replays are harmless; combines map-side."""
    return log.select(key, stamp).unionByName(new.select(key, stamp)).groupBy(key).agg(F.max(stamp).alias(stamp))


def batch_name(number: int) -> str:
    """Batch numbers as text that sorts like the numbers."""
    return f"{number:012d}"


def append_contacts(contacts: DataFrame, path: str, batch_id: str) -> None:
    """Add one batch of contacts as its own folder; writing the same batch again replaces it."""
    contacts.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


MERGED = T.StructType([T.StructField("batch", T.StringType()), T.StructField("merge", T.StringType())])


def merged_batches(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Batches that a compaction has put into another one, with that one's name; as many as came between two compactions."""
    return [(r.batch, r.merge) for r in read_or_empty(spark, f"{path}-merged", MERGED).collect()]


def _live(spark: SparkSession, path: str, key: str, stamp: str, key_type: T.DataType) -> DataFrame:
    """The rows of the batches that are in force, with their batch. The list of merged ones is read first: a merge that
    comes after is not missed, its batches are then read apart."""
    merged = [batch for batch, _ in merged_batches(spark, path)]
    rows = read_or_empty(spark, path, T.StructType([*_log_schema(key, stamp, key_type), T.StructField("batch", T.StringType())]))
    return rows.filter(~F.col("batch").isin(merged)) if merged else rows


def read_contacts(
    spark: SparkSession, path: str, key: str, stamp: str, key_type: T.DataType = T.StringType()
) -> DataFrame:
    """The appended batches reduced to the latest stamp per key; no batch yet means an empty log."""
    return _live(spark, path, key, stamp, key_type).groupBy(key).agg(F.max(stamp).alias(stamp))


def compact_contacts(
    spark: SparkSession, path: str, key: str, stamp: str, key_type: T.DataType = T.StringType()
) -> None:
    """Put all batches so far into one with a row per key.

    The merged batch is written first, then by one file the list of those it stands for, from when on readers skip them.
    Their folders stay until the next compaction, so that a read that began before this one ends as it began. A batch that a
    running stream writes again meanwhile only adds what the merge has: the table says the same at every moment.
    """
    before = merged_batches(spark, path)
    live = _live(spark, path, key, stamp, key_type)
    old = sorted(r[0] for r in live.select("batch").distinct().collect())
    if len(old) > 1:
        merge = f"merged-{uuid.uuid4().hex}"
        append_contacts(live.groupBy(key).agg(F.max(stamp).alias(stamp)), path, merge)
        spark.createDataFrame([(b,) for b in old], "batch STRING").coalesce(1).write.parquet(f"{path}-merged/merge={merge}")
    for batch, _ in before:
        remove(spark, f"{path}/batch={batch}")
    for merge in {merge for _, merge in before}:
        remove(spark, f"{path}-merged/merge={merge}")
