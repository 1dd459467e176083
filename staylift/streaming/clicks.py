"""Button clicks: read, check, decode, route, and turn into approved ids.

Every function works on a batch frame as well as on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylift.functions.clock import from_epoch_seconds
from staylift.functions.text import strip
from staylift.operators.filters import parse_ids
from staylift.schemas import CLICK_PAYLOAD, CLICK_REQUEST
from staylift.streaming.contacts import append_by_day, before_batch, read_since, run_batches

MAX_AGE_SECONDS = 300

# Button id -> (workflow, test mail?, needs ids?).
ROUTES = {
    "test_upsell_email": ("weekly_upsell", True, False),
    "test_monthly_report": ("monthly_report", True, False),
    "send_upsell_email": ("weekly_upsell", False, True),
    "send_all_upsell": ("weekly_upsell", False, True),
    "send_monthly_report": ("monthly_report", False, True),
    "send_all_monthly_report": ("monthly_report", False, True),
}


def read_clicks(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Requests as the gateway lands them, one JSON object per line. ``max_files`` bounds a micro-batch."""
    return spark.readStream.schema(CLICK_REQUEST).option("maxFilesPerTrigger", max_files).json(path)


def is_fresh(max_age: int = MAX_AGE_SECONDS) -> Column:
    """Null where stamp or arrival is missing or no number."""
    sent_at = from_epoch_seconds(F.col("request_ts").try_cast("decimal(18,6)"))
    leeway = F.make_dt_interval(secs=F.lit(max_age).cast("decimal(18,6)"))
    return F.col("arrived_at").between(sent_at - leeway, sent_at + leeway)


def fresh_clicks(clicks: DataFrame, max_age: int = MAX_AGE_SECONDS) -> DataFrame:
    """Reject requests stamped more than ``max_age`` seconds away from their arrival.

    ``request_ts`` is the sender's epoch second, counted on the same clock as ``arrived_at``; a stamp
    that is missing or not a number is rejected. Arrival is data, so a replay decides the same.
    """
    return clicks.filter(is_fresh(max_age))


PAYLOAD_FIELD = "(?:^|&)payload=([^&]*)"
#: Why a click is of no use, in the order of the tests; ``repeated`` is for deliveries beyond the first.
CLICK_REASONS = ("no arrival", "stale", "no payload", "unreadable", "no action", "unknown button", "no ids", "repeated")
#: Why an id of a click that is of use is not: it is no number, or the gate holds it back.
ID_REASONS = ("unusable id", "held back")


def with_reason(clicks: DataFrame, max_age: int = MAX_AGE_SECONDS) -> DataFrame:
    """Add ``reason``: null for what ``fresh_clicks`` and ``route_clicks`` let through, else the first that applies.

    A form without a payload, a payload that is no JSON, another kind of request or one without an action, a button that
    leads nowhere, and a button that needs ids without any are told apart.
    """
    form = F.regexp_extract("form_body", PAYLOAD_FIELD, 1)
    decoded = F.try_url_decode(form)
    payload = F.from_json(decoded, CLICK_PAYLOAD)
    needs_ids = F.try_element_at(F.create_map(*[F.lit(x) for name, (*_, needs) in ROUTES.items() for x in (name, needs)]), F.col("_first.action_id"))
    judged = clicks.withColumns({"_form": form, "_decoded": decoded, "_payload": payload})
    judged = judged.withColumn("_first", F.when(F.col("_payload.type") == "block_actions", F.get("_payload.actions", F.lit(0))))
    blank = F.coalesce("_first.value", F.lit("")) == ""
    # Only what has no action is parsed a second time, to tell what is no JSON from what is something else.
    no_json = F.col("_decoded").isNull() | F.try_parse_json("_decoded").isNull()
    tests = [
        F.col("arrived_at").isNull(), ~F.coalesce(is_fresh(max_age), F.lit(False)), F.coalesce(F.col("_form"), F.lit("")) == "",
        F.col("_first").isNull() & no_json, F.col("_first").isNull(), needs_ids.isNull(), needs_ids & blank,
    ]
    reason = F.lit(None).cast("string")
    for test, name in reversed(list(zip(tests, CLICK_REASONS, strict=False))):
        reason = F.when(test, F.lit(name)).otherwise(reason)
    return judged.withColumn("reason", reason).drop("_form", "_decoded", "_payload", "_first")


REJECTS = T.StructType(
    [
        T.StructField("click_id", T.LongType()),
        T.StructField("arrived_at", T.TimestampNTZType()),
        T.StructField("reason", T.StringType()),
        T.StructField("detail", T.StringType()),
        T.StructField("rows", T.LongType()),
    ]
)


def as_rejects(rows: DataFrame, reason: Column, detail: Column, count: Column | None = None) -> DataFrame:
    count = F.lit(1) if count is None else count
    return rows.select("click_id", "arrived_at", reason.alias("reason"), detail.cast("string").alias("detail"), count.cast("long").alias("rows"))


def unusable_ids(routed: DataFrame) -> DataFrame:
    """The parts of clicks' id lists that are no numbers, blanks aside, as rejects."""
    parts = F.filter(F.transform(F.split("acm_ids", ","), strip), lambda part: (part != "") & part.try_cast("bigint").isNull())
    bad = routed.select("click_id", "arrived_at", F.explode(parts).alias("part"))
    return as_rejects(bad, F.lit("unusable id"), F.col("part"))


def decode_clicks(clicks: DataFrame) -> DataFrame:
    """Add ``payload``: the JSON of the form field of that name."""
    field = F.regexp_extract("form_body", PAYLOAD_FIELD, 1)
    return clicks.withColumn("payload", F.from_json(F.try_url_decode(field), CLICK_PAYLOAD))


def _carried(clicks: DataFrame) -> list[str]:
    """What a click keeps on its way."""
    return [c for c in ("click_id", "arrived_at") if c in clicks.columns]


def route_clicks(clicks: DataFrame) -> DataFrame:
    """One row per actionable click: workflow, test_mode, acm_ids. Only a payload's first action counts."""
    routes = F.create_map(
        *[
            part
            for action, (workflow, test, needs_ids) in ROUTES.items()
            for part in (
                F.lit(action),
                F.struct(
                    F.lit(workflow).alias("workflow"), F.lit(test).alias("test_mode"), F.lit(needs_ids).alias("needs_ids")
                ),
            )
        ]
    )
    # One generator takes the decision on the payload, so that it is parsed once per click and not again
    # for every filter that would otherwise be pushed below it.
    first = F.when(F.col("payload.type") == "block_actions", F.slice("payload.actions", 1, 1))
    routed = (
        decode_clicks(clicks)
        .select(*_carried(clicks), F.inline(first).alias("action_id", "acm_ids"))
        .withColumns({"acm_ids": F.coalesce("acm_ids", F.lit("")), "route": F.try_element_at(routes, F.col("action_id"))})
        .filter(F.col("route").isNotNull() & (~F.col("route.needs_ids") | (F.col("acm_ids") != "")))
    )
    return routed.select(*_carried(clicks), "action_id", "acm_ids", "route.workflow", "route.test_mode")


def explode_approvals(routed: DataFrame) -> DataFrame:
    """One row per approved id. ``bulk_size`` counts the comma-separated parts, usable or not.

    A test click that names no ids keeps one row without an id: it asks for the first of the list (see ``asked_for``).
    """
    parts = F.when(F.col("acm_ids") == "", 0).otherwise(F.size(F.split("acm_ids", ",")))
    rows = routed.select(
        *_carried(routed), "workflow", "test_mode", "acm_ids", parts.alias("bulk_size"),
        F.explode_outer(parse_ids(F.col("acm_ids"))).alias("acm_id"),
    )
    return rows.filter(F.col("acm_id").isNotNull() | (F.col("test_mode") & (F.col("acm_ids") == ""))).drop("acm_ids")


def repeats(clicks: DataFrame, kept: DataFrame) -> DataFrame:
    """Deliveries beyond those ``kept``, as rejects: one row per delivery, ``rows`` of them."""
    given = clicks.withColumn("delivery", delivery_of()).groupBy("delivery").agg(F.count("*").alias("n"), F.max(F.struct("arrived_at", "click_id")).alias("late"))
    beyond = given.join(kept.groupBy("delivery").agg(F.count("*").alias("kept")), "delivery", "left")
    beyond = beyond.withColumn("n", F.col("n") - F.coalesce("kept", F.lit(0))).filter("n > 0").select("late.*", "n", "delivery")
    return as_rejects(beyond, F.lit("repeated"), F.col("delivery"), F.col("n"))


def delivery_of() -> Column:
    """What tells a request sent again from another one: its own stamp and form."""
    return F.sha2(F.concat_ws("\n", "request_ts", "form_body"), 256).alias("delivery")


def first_deliveries(clicks: DataFrame) -> DataFrame:
    """Each delivery (same stamp, same form) once: the copy that arrived first, then the smallest click_id.

    The aggregation combines map-side, so a request repeated a great many times is no hot task.
    """
    first = F.min(F.struct("arrived_at", "click_id", "request_ts", "form_body")).alias("first")
    return clicks.groupBy(delivery_of()).agg(first).select("first.*", "delivery")


def keep_deliveries(clicks: DataFrame, path: str, name: str, within_minutes: int = 10) -> DataFrame:
    """Of a micro-batch, the deliveries that no earlier batch kept within the delay; they are added to the table at ``path``.

    The table is the only memory, and no more than the delay's days of it are read. Running a batch again gives the same.
    """
    spark = clicks.sparkSession
    first = first_deliveries(clicks)
    lo = first.agg(F.min("arrived_at")).first()[0]
    if lo is None:
        return first
    delay = F.make_dt_interval(mins=F.lit(within_minutes))
    seen = read_since(spark, path, first.schema, F.lit(lo).cast("timestamp_ntz") - delay).filter(before_batch("batch", name))
    seen = seen.select(F.col("delivery").alias("seen"), F.col("arrived_at").alias("seen_at"))
    again = (first["delivery"] == seen["seen"]) & F.col("arrived_at").between(F.col("seen_at") - delay, F.col("seen_at") + delay)
    append_by_day(first.join(seen, again, "left_anti"), "arrived_at", path, name)
    since = F.lit(lo).cast("timestamp_ntz")
    return read_since(spark, path, first.schema, since).filter(F.col("batch") == name).select(*first.columns)


def start_deliveries(clicks: DataFrame, path: str, checkpoint: str, within_minutes: int = 10, **trigger):
    """Keep each delivery of a stream of clicks once, in a table by day."""
    name = run_batches(checkpoint)
    return (
        clicks.writeStream.foreachBatch(lambda rows, batch: keep_deliveries(rows, path, name(rows.sparkSession, batch), within_minutes))
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )
