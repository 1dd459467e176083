"""Contacts over time: the latest one per key, and the gate that spaces them out.

State lives in tables and not in state stores: every micro-batch writes folders named by run and batch, so a repeated
batch replaces itself, a run that starts over leaves the folders of the one before in force, and no key is held in
memory.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylift.operators.numbering import running_total
from staylift.sources.contact_log import append_contacts, batch_name, read_or_empty
from staylift.sources.workspace import scratch, settle

PARTS = [T.StructField("day", T.StringType()), T.StructField("batch", T.StringType())]


def run_batches(checkpoint: str) -> Callable[[SparkSession, int], str]:
    """Names for a stream's batches: the run (one per checkpoint, lost with it) and the number, which sort by number."""
    known: dict[str, str] = {}

    def name(spark: SparkSession, batch: int) -> str:
        if "run" not in known:
            known["run"] = spark.read.json(f"{checkpoint}/metadata").first()["id"]
        return f"{known['run']}-{batch_name(batch)}"

    return name


def before_batch(column: str, name: str) -> Column:
    """Rows that were there when batch ``name`` first ran: those of other runs, and of its own earlier batches."""
    run = name.rpartition("-")[0]
    return ~F.startswith(F.col(column), F.lit(f"{run}-")) | (F.col(column) < name)


def append_by_day(rows: DataFrame, stamp: str, path: str, name: str) -> None:
    """Add a batch's rows in folders by day and batch; the same batch again replaces its folders."""
    placed = rows.withColumns({"day": F.date_format(stamp, "yyyy-MM-dd"), "batch": F.lit(name)})
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day", "batch").parquet(path)


def read_since(spark: SparkSession, path: str, schema: T.StructType, since: Column) -> DataFrame:
    """What ``append_by_day`` wrote, from the day of ``since`` on: older folders are not opened."""
    stored = read_or_empty(spark, path, T.StructType([*schema, *PARTS]))
    return stored.filter(F.col("day") >= F.date_format(since, "yyyy-MM-dd"))


def start_contact_state(contacts: DataFrame, key: str, stamp: str, path: str, checkpoint: str, **trigger):
    """Keep the latest ``stamp`` per ``key`` in a contact table that ``read_contacts`` reads.

    Each micro-batch is reduced to one row per key it has; the table merges batches when it is read, so nothing is kept
    between them.
    """
    name = run_batches(checkpoint)

    def keep(rows: DataFrame, batch: int) -> None:
        append_contacts(rows.groupBy(key).agg(F.max(stamp).alias(stamp)), path, name(rows.sparkSession, batch))

    return (
        contacts.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


#: Contacts of one key that are judged in one array; keys with more are judged by pointers.
SHORT = 256
KEY = "_key"


def _within_a_row(contacts: DataFrame, columns: list[str], stamp: str, ident: str) -> DataFrame:
    """Keys of bounded length: their contacts in order, folded in one expression."""
    gap = F.make_dt_interval(days=F.col(columns[-1]))
    entry = F.struct(F.col(stamp).alias("at"), F.col(ident).alias("who"))
    told = contacts.groupBy(KEY, *columns).agg(F.sort_array(F.collect_list(entry)).alias("_all"))

    def judged(passed: Column, x: Column) -> Column:
        return F.when((F.size(passed) == 0) | (x["at"] > F.element_at(passed, -1)["at"] + gap), F.concat(passed, F.array(x))).otherwise(passed)

    kind = told.schema["_all"].dataType.simpleString()
    passed = told.select(*columns, F.explode(F.aggregate("_all", F.array().cast(kind), judged)).alias("p"))
    return passed.select(*columns, F.col("p.at").alias(stamp), F.col("p.who").alias(ident))


def next_due(contacts: DataFrame, gap_days: str, stamp: str) -> tuple[DataFrame, DataFrame]:
    """Contacts with their number in their key (from 0), and for each the number of the first one that is due after it.

    A contact's number counts the earlier ones of its key, the other one those up to the end of its gap. Both come from one
    running total over contacts and ends of gaps in one order, so that a key of any length is cut into many partitions.
    """
    ends = contacts.withColumns({"_at": F.col(stamp) + F.make_dt_interval(days=F.col(gap_days)), "_end": F.lit(True)})
    both = contacts.withColumns({"_at": F.col(stamp), "_end": F.lit(False)}).unionByName(ends)
    weight = F.when(F.col("_end"), 0).otherwise(1)
    counted = settle(running_total(settle(both), [KEY], ["_at", "_end"], weight, "_upto"))
    numbered = counted.filter("NOT _end").drop("_at", "_end").withColumnRenamed("_upto", "_no")
    due = counted.filter("_end").select(KEY, stamp, F.col("_upto").alias("_next"))
    return numbered, due


def _by_pointers(contacts: DataFrame, columns: list[str], stamp: str, ident: str) -> DataFrame:
    """Keys of any length: follow the links to the next due contact, twice as far every round.

    A contact that is due after the one right before it passes whatever passed earlier: it is the head of a run, and links to
    it need not be followed. What passes in a run is the chain of links from its head. A round joins what is reached with
    the links of 1, 2, 4, … steps, and each link with the link where it ends; so there are as many rounds as the longest
    chain within a run has binary digits, and links that lead out of their run are gone.
    """
    numbered, due = next_due(contacts, columns[-1], stamp)
    links = settle(numbered.select(KEY, stamp, "_no").join(due, [KEY, stamp]).select(KEY, "_no", "_next"))
    first = numbered.filter("_no = 0").select(KEY, "_no")
    heads = settle(first.unionByName(links.filter("_next = _no + 1").select(KEY, F.col("_next").alias("_no"))))
    to_heads = heads.select(KEY, F.col("_no").alias("_next"))
    # A link past the last contact ends nowhere.
    onward = links.join(to_heads, [KEY, "_next"], "left_anti").join(numbered.select(KEY, F.col("_no").alias("_next")), [KEY, "_next"], "left_semi")
    jump = settle(onward.select(KEY, "_no", "_next"))
    reached = heads
    while not jump.isEmpty():
        step = reached.join(jump, [KEY, "_no"]).select(KEY, F.col("_next").alias("_no"))
        reached = reached.unionByName(settle(step))
        on = jump.select(KEY, F.col("_no").alias("_next"), F.col("_next").alias("_far"))
        jump = settle(jump.join(on, [KEY, "_next"]).select(KEY, "_no", F.col("_far").alias("_next")))
    return numbered.join(reached, [KEY, "_no"], "left_semi").select(*columns, stamp, ident)


def frequency_gate_batch(
    contacts: DataFrame, keys: list[str], stamp: str, ident: str, gap_days: str, last: DataFrame | None = None, short: int = SHORT
) -> DataFrame:
    """Per key, pass a contact only if the previous *passed* one is more than ``gap_days`` old. All keys alike.

    ``gap_days`` names a column; contacts of one key with different gaps are judged apart. Of contacts of the same moment the
    smallest ``ident`` counts. Keys of at most ``short`` contacts are judged in one aggregation each; longer ones, of any
    length, by links to the next due contact, followed twice as far every round, so that neither rows nor rounds follow the
    length of time or the smallest gap. A gap that is null or not positive holds nothing back but further contacts of the
    same moment.

    ``last`` (keys, gap, ``last``) continues an earlier run; a contact not later than its key's ``last`` does not pass.
    Stored tables are scratch of the job.
    """
    spark = contacts.sparkSession
    columns = [*keys, gap_days]
    rows = contacts.select(*columns, stamp, ident)
    if last is None:
        last = spark.createDataFrame([], T.StructType([*rows.select(*columns).schema, T.StructField("last", T.TimestampNTZType())]))
    same = reduce(and_, [F.col(f"c.{c}").eqNullSafe(F.col(f"k.{c}")) for c in columns])
    waits = F.coalesce(F.col(f"c.{gap_days}") > 0, F.lit(False))
    until = F.when(waits, F.col("k.last") + F.make_dt_interval(days=F.col(f"c.{gap_days}"))).otherwise(F.col("k.last"))
    moments = rows.groupBy(*columns, stamp).agg(F.min(ident).alias(ident)).alias("c").join(last.alias("k"), same, "left")
    moments = moments.filter(F.col("k.last").isNull() | (F.col(f"c.{stamp}") > until))
    moments = settle(moments.select(*[f"c.{c}" for c in [*columns, stamp, ident]], waits.alias("_waits"), F.to_json(F.struct(*[f"c.{c}" for c in columns])).alias(KEY)))

    passed = moments.filter("NOT _waits").select(*columns, stamp, ident)
    waiting = moments.filter("_waits").drop("_waits")
    long = settle(waiting.groupBy(KEY).agg(F.count("*").alias("n")).filter(F.col("n") > short).select(KEY))
    if long.isEmpty():
        return passed.unionByName(_within_a_row(waiting, columns, stamp, ident))
    passed = passed.unionByName(_within_a_row(waiting.join(long, KEY, "left_anti"), columns, stamp, ident))
    return passed.unionByName(_by_pointers(settle(waiting.join(long, KEY, "left_semi")), columns, stamp, ident))


def gate_batch(arrived: DataFrame, keys: list[str], stamp: str, ident: str, gap_days: str, path: str, name: str) -> None:
    """Judge one micro-batch against what passed before it, and add what passes to the table at ``path``.

    Only contacts that passed within the longest gap before the batch's earliest one can hold anything back, so only their
    days are read. A contact later than all that passed is judged like any other; one that comes late does not pass
    once a later contact of its key has.
    """
    spark, columns = arrived.sparkSession, [*keys, gap_days]
    schema = arrived.select(*columns, stamp, ident).schema
    span = arrived.agg(F.min(stamp).alias("lo"), F.max(gap_days).alias("gap")).first()
    if span.lo is None:
        return
    since = F.lit(span.lo).cast("timestamp_ntz") - F.make_dt_interval(days=F.lit(max(0, span.gap or 0)))
    earlier = read_since(spark, path, schema, since).filter(before_batch("batch", name))
    last = earlier.groupBy(*columns).agg(F.max(stamp).alias("last"))
    with scratch(spark):
        append_by_day(frequency_gate_batch(arrived, keys, stamp, ident, gap_days, last), stamp, path, name)


def start_gate(contacts: DataFrame, keys: list[str], stamp: str, ident: str, gap_days: str, path: str, checkpoint: str, **trigger):
    """Run a stream of contacts through ``frequency_gate_batch``, micro-batch by micro-batch, into a table by day."""
    name = run_batches(checkpoint)

    def judge(rows: DataFrame, batch: int) -> None:
        gate_batch(rows, keys, stamp, ident, gap_days, path, name(rows.sparkSession, batch))

    return (
        contacts.writeStream.foreachBatch(judge).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
