"""From clicks to approved contacts, as one stream."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylift.sources.contact_log import read_or_empty
from staylift.sources.outbox import OUTBOX
from staylift.sources.runs import RUN, published
from staylift.sources.workspace import scratch, settle
from staylift.streaming.clicks import (
    REJECTS, as_rejects, explode_approvals, fresh_clicks, keep_deliveries, repeats, route_clicks, unusable_ids, with_reason,
)
from staylift.streaming.contacts import PARTS, append_by_day, gate_batch, run_batches

GAP_DAYS = {"weekly_upsell": 14, "monthly_report": 25}
KEYS = ["workflow", "acm_id"]
PASSED = T.StructType(
    [
        T.StructField("workflow", T.StringType()),
        T.StructField("acm_id", T.LongType()),
        T.StructField("gap_days", T.IntegerType()),
        T.StructField("arrived_at", T.TimestampNTZType()),
        T.StructField("click_id", T.LongType()),
    ]
)
TESTS = T.StructType([f for f in PASSED if f.name != "gap_days"])


def gap_of(workflow: Column) -> Column:
    pairs = [F.lit(part) for item in GAP_DAYS.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), workflow)


def approved(clicks: DataFrame) -> DataFrame:
    """Fresh clicks as (workflow, test_mode, acm_id) rows."""
    return explode_approvals(route_clicks(fresh_clicks(clicks)))


def _append(rows: DataFrame, path: str, name: str) -> None:
    append_by_day(rows, "arrived_at", path, name)


def judge_clicks(rows: DataFrame, path: str, name: str, within_minutes: int = 10) -> None:
    """One micro-batch of clicks, split without loss, under one batch name.

    What passes the gate goes to ``path``, test clicks to ``<path>-tests``, and whatever else came to ``<path>-rejects`` with
    its reason: clicks that are of no use or came before, ids that are none, contacts that the gate holds back. The batch is
    named in ``<path>-batches`` last, and only then is it there for ``claim_approvals``. Running it again replaces it.
    """
    spark = rows.sparkSession
    with scratch(spark):
        judged = settle(with_reason(rows))
        good = judged.filter("reason IS NULL").drop("reason")
        once = settle(keep_deliveries(good, f"{path}-deliveries", name, within_minutes))
        routed = settle(route_clicks(once))
        asked = settle(explode_approvals(routed))
        real = asked.filter("NOT test_mode").withColumn("gap_days", gap_of(F.col("workflow")))
        gate_batch(real, KEYS, "arrived_at", "click_id", "gap_days", path, name)
        passed = read_or_empty(spark, path, T.StructType([*PASSED, *PARTS])).filter(F.col("batch") == name)
        held = real.join(passed, [*KEYS, "click_id"], "left_anti")
        rejects = [
            as_rejects(judged.filter("reason IS NOT NULL"), F.col("reason"), F.col("form_body")), repeats(good, once), unusable_ids(routed),
            as_rejects(held, F.lit("held back"), F.concat_ws(" ", "workflow", F.col("acm_id").cast("string"))),
        ]
        _append(asked.filter("test_mode").select(*TESTS.names), f"{path}-tests", name)
        _append(reduce(DataFrame.unionByName, rejects), f"{path}-rejects", name)
    spark.createDataFrame([(name,)], "name STRING").coalesce(1).write.mode("overwrite").parquet(f"{path}-batches/batch={name}")


def start_approvals(clicks: DataFrame, path: str, checkpoint: str, within_minutes: int = 10, **trigger):
    """Approved contacts, spaced per workflow and accommodation by the workflow's cool-down.

    A delivery counts once (``<path>-deliveries`` remembers them). Test sends are not contacts, so they neither wait nor
    count. See ``judge_clicks`` for the tables a micro-batch writes.
    """
    name = run_batches(checkpoint)
    return (
        clicks.writeStream.foreachBatch(lambda rows, batch: judge_clicks(rows, path, name(rows.sparkSession, batch), within_minutes))
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


@dataclass(frozen=True)
class Claim:
    """Approvals that one run is to act on: ``ids`` has workflow, test_mode, acm_id (null: the first of the list)."""

    run: str
    ids: DataFrame


OFFSETS = T.StructType([T.StructField("stream", T.StringType()), T.StructField("upto", T.StringType())])


def _numbered(batches: DataFrame) -> DataFrame:
    """``batch`` with its stream and the number in it, which is text that sorts like the number."""
    part = r"^(.*)-(\d+)$"
    return batches.select("batch", F.regexp_extract("batch", part, 1).alias("stream"), F.regexp_extract("batch", part, 2).alias("number"))


def claim_approvals(spark: SparkSession, path: str, outbox: str, run: str) -> Claim | None:
    """The approvals that no run has taken, for run ``run`` to act on and publish in ``outbox``; None if there are none.

    ``<outbox>/offsets`` has, per run, how far it takes each stream of approvals; a claim is written there before it is used.
    A run that claimed but did not publish goes first: its claim comes back under its own name, with the same approvals, so
    that a job that broke off is repeated as it was, and one that published is not repeated. Only one job at a time may
    claim from an outbox.
    """
    batches = _numbered(read_or_empty(spark, f"{path}-batches", T.StructType([T.StructField("name", T.StringType()), PARTS[1]])))
    offsets = settle(read_or_empty(spark, f"{outbox}/offsets", T.StructType([*OFFSETS, RUN])))
    unpublished = offsets.join(published(spark, outbox), "run", "left_anti").select("run").distinct().orderBy("run").first()
    if unpublished is None:
        if not offsets.filter(F.col("run") == run).isEmpty():
            raise ValueError(f"run {run} is published; a new run needs a name of its own")
        taken = offsets.groupBy("stream").agg(F.max("upto").alias("upto"))
        new = batches.join(taken, "stream", "left").filter(F.col("upto").isNull() | (F.col("number") > F.col("upto")))
        new = settle(new.groupBy("stream").agg(F.max("number").alias("upto")))
        if new.isEmpty():
            return None
        new.select(*OFFSETS.names).coalesce(1).write.mode("overwrite").parquet(f"{outbox}/offsets/run={run}")
        offsets = settle(offsets.unionByName(new.withColumn("run", F.lit(run))))
    else:
        run = unpublished.run
    own = offsets.filter(F.col("run") == run).select("stream", "upto")
    before = offsets.filter(F.col("run") != run).groupBy("stream").agg(F.max("upto").alias("after"))
    mine = batches.join(own, "stream").join(before, "stream", "left")
    mine = settle(mine.filter((F.col("number") <= F.col("upto")) & (F.col("after").isNull() | (F.col("number") > F.col("after")))).select("batch"))
    real = read_or_empty(spark, path, T.StructType([*PASSED, *PARTS])).join(mine, "batch", "left_semi")
    tests = read_or_empty(spark, f"{path}-tests", T.StructType([*TESTS, *PARTS])).join(mine, "batch", "left_semi")
    ids = real.select("workflow", F.lit(False).alias("test_mode"), "acm_id").unionByName(tests.select("workflow", F.lit(True).alias("test_mode"), "acm_id"))
    return Claim(run, settle(ids.distinct()))


def approvals_outbox(spark: SparkSession, path: str) -> DataFrame:
    """What the gate let through, as outbox rows of kind ``approval``."""
    passed = read_or_empty(spark, path, T.StructType([*PASSED, *PARTS]))
    rows = passed.withColumns({"run_date": F.date_format("arrived_at", "yyyy-MM-dd"), "kind": F.lit("approval")})
    return rows.select(
        *[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in OUTBOX]
    )


def rejected(spark: SparkSession, path: str) -> DataFrame:
    """What a stream of approvals turned away: click_id, arrived_at, reason, detail, rows."""
    return read_or_empty(spark, f"{path}-rejects", T.StructType([*REJECTS, *PARTS])).select(*REJECTS.names)
