import json
import random
from datetime import datetime, timedelta
from urllib.parse import quote_plus

import pytest
from pyspark.sql import functions as F

from staylift.plans.approved import mail_approved, published_mails, sent_log
from staylift.sources import contact_log, runs
from staylift.streaming import approvals, clicks, contacts

T0 = datetime(2025, 6, 1, 9, 0)
CONTACT = "acm_id LONG, contacted_at TIMESTAMP_NTZ, event_id LONG, gap_days INT"


def epoch(moment: datetime) -> str:
    return str(int((moment - datetime(1970, 1, 1)).total_seconds()))


def click(click_id, action="send_upsell_email", value="1", at=T0, age=0, kind="block_actions", payload=None, actions=None):
    if payload is None:
        actions = [{"action_id": action, "value": value}] if actions is None else actions
        payload = json.dumps({"type": kind, "actions": actions})
    return {"click_id": click_id, "form_body": "a=b&payload=" + quote_plus(payload), "request_ts": epoch(at), "arrived_at": str(at + timedelta(seconds=age))}


def batch(spark, rows):
    return spark.createDataFrame([(r["click_id"], r["form_body"], r["request_ts"], datetime.fromisoformat(r["arrived_at"])) for r in rows],
                                 "click_id LONG, form_body STRING, request_ts STRING, arrived_at TIMESTAMP_NTZ")


def write(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows))


def test_freshness_is_inclusive_and_rejects_bad_stamps(spark):
    rows = [click(0, age=300), click(1, age=301), click(2, age=-300), click(3, age=-301)]
    rows += [{**click(4), "request_ts": ""}, {**click(5), "request_ts": "soon"}, {**click(6), "request_ts": epoch(T0) + ".5"}]
    assert sorted(r.click_id for r in clicks.fresh_clicks(batch(spark, rows)).collect()) == [0, 2, 6]


def test_routing(spark):
    rows = [
        click(0, "test_upsell_email", ""), click(1, "test_monthly_report", "5"), click(2, "send_upsell_email", "5"), click(3, "send_all_upsell", "5,6"),
        click(4, "send_monthly_report", "5"), click(5, "send_all_monthly_report", "5"), click(6, "send_upsell_email", ""), click(7, "unknown", "5"),
        click(8, kind="url_verification"), click(9, actions=[]), click(10, payload="not json"), click(11, payload="{}"),
        click(12, actions=[{"action_id": "send_all_upsell", "value": "1"}, {"action_id": "test_upsell_email", "value": "2"}]),
        click(13, actions=[{"action_id": "test_upsell_email"}]),
        {**click(14), "form_body": "x=1"}, {**click(15), "form_body": "payload=%zz"},
    ]
    routed = {r.click_id: (r.workflow, r.test_mode, r.acm_ids) for r in clicks.route_clicks(batch(spark, rows)).collect()}
    assert routed == {
        0: ("weekly_upsell", True, ""), 1: ("monthly_report", True, "5"), 2: ("weekly_upsell", False, "5"), 3: ("weekly_upsell", False, "5,6"),
        4: ("monthly_report", False, "5"), 5: ("monthly_report", False, "5"), 12: ("weekly_upsell", False, "1"), 13: ("weekly_upsell", True, ""),
    }


def test_approvals_explode_each_id_once(spark):
    rows = clicks.explode_approvals(clicks.route_clicks(batch(spark, [click(0, "send_all_upsell", " 7, 8,,7,x")]))).collect()
    assert sorted((r.acm_id, r.bulk_size) for r in rows) == [(7, 5), (8, 5)]


def gate(rows):
    """One pass in time order, key by key."""
    last, passed = {}, []
    for acm, at, event, gap in sorted(rows, key=lambda r: (r[1], r[2])):
        if (acm, gap) not in last or at - last[acm, gap] > timedelta(days=gap):
            last[acm, gap] = at
            passed.append((acm, at, event))
    return sorted(passed)


def contacts_of(seed, n=400, keys=6, hot=0.4):
    rng = random.Random(seed)
    return [
        (0 if rng.random() < hot else rng.randrange(1, keys), T0 + timedelta(minutes=rng.randrange(60 * 24 * 60)), i, 14) for i in range(n)
    ] + [(90, T0, 9001, 14), (90, T0 + timedelta(days=14), 9002, 14), (90, T0 + timedelta(days=14, microseconds=1), 9003, 14)]


def judged(df, **options):
    return contacts.frequency_gate_batch(df, ["acm_id"], "contacted_at", "event_id", "gap_days", **options)


def told(rows):
    return sorted((r.acm_id, r.contacted_at, r.event_id) for r in rows)


@pytest.mark.parametrize("gaps", [(14, 14), (14, 25), (1, 3), (2, 60), (0, 5)])
def test_gate_batch_equals_one_pass(spark, gaps):
    rows = [(*r[:3], gaps[0]) for r in contacts_of(sum(gaps))] + [(acm, at, event + 20_000, gaps[1]) for acm, at, event, _ in contacts_of(7, 60)]
    passed = judged(spark.createDataFrame(rows, CONTACT))
    assert told(passed.collect()) == gate(rows)
    assert judged(spark.createDataFrame([], CONTACT)).count() == 0


def test_gate_batch_with_nulls_and_an_earlier_run(spark):
    rows = [(None, T0, 1, 7), (None, T0 + timedelta(days=3), 2, 7), (None, T0 + timedelta(days=8), 3, 7), (5, T0, 4, None), (5, T0, 5, None), (5, T0 + timedelta(days=1), 6, None)]
    rows += [(6, T0, 7, 7), (6, T0 + timedelta(days=5), 8, 7), (7, T0, 9, 7)]
    last = spark.createDataFrame([(6, 7, T0 - timedelta(days=3)), (7, 7, T0 + timedelta(days=30))], "acm_id LONG, gap_days INT, last TIMESTAMP_NTZ")
    passed = judged(spark.createDataFrame(rows, CONTACT), last=last).collect()
    assert sorted(r.event_id for r in passed) == [1, 3, 4, 6, 8]


def stored_rows(monkeypatch, rows, **options):
    """What passes, the rows of each table that judging stores, and how many rounds followed links."""
    sizes, real = [], contacts.settle

    def spied(df):
        made = real(df)
        sizes.append((made.columns, made.count()))
        return made

    monkeypatch.setattr(contacts, "settle", spied)
    passed = told(judged(rows, **options).collect())
    links = [n for columns, n in sizes if columns == [contacts.KEY, "_no", "_next"]]
    return passed, sum(n for _, n in sizes), len(links) - 2


@pytest.mark.parametrize("short", [0, 1, 20])
@pytest.mark.parametrize("gap", [1, 14])
def test_gate_by_links_equals_one_pass(spark, short, gap):
    rows = [(*r[:3], gap) for r in contacts_of(gap, 300)] + [(None, T0 + timedelta(days=n * 0.7), 30_000 + n, gap) for n in range(30)]
    passed = told(judged(spark.createDataFrame(rows, CONTACT), short=short).withColumn("acm_id", F.coalesce("acm_id", F.lit(-1))).collect())
    assert passed == gate([(-1 if r[0] is None else r[0], *r[1:]) for r in rows])


def test_rows_stored_do_not_follow_the_smallest_gap(spark, monkeypatch):
    rows = [(n, T0 + timedelta(hours=n % 288), n, 25) for n in range(2000)] + [(5000, T0 + timedelta(days=n, minutes=n), 9000 + n, 1) for n in range(12)]
    passed, stored, _ = stored_rows(monkeypatch, spark.createDataFrame(rows, CONTACT))
    assert passed == gate(rows) and stored <= 2 * len(rows)


def test_rounds_follow_the_chain_and_not_the_time(spark, monkeypatch):
    # Ten years: contacts far apart are heads of runs of their own and need no round.
    apart = [(1, T0 + timedelta(days=2 * n), n, 1) for n in range(1800)]
    passed, stored, rounds = stored_rows(monkeypatch, spark.createDataFrame(apart, CONTACT), short=0)
    assert len(passed) == 1800 and rounds == 0 and stored <= 9 * len(apart)
    # One run: every second contact passes, 512 in a chain.
    close = [(1, T0 + timedelta(hours=16 * n), n, 1) for n in range(1024)]
    passed, stored, rounds = stored_rows(monkeypatch, spark.createDataFrame(close, CONTACT), short=100)
    assert passed == gate(close) and rounds <= 10 and stored <= 20 * len(close)


def stream_of(spark, path):
    return spark.readStream.schema(CONTACT).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(str(path))


def land(spark, path, rows):
    spark.createDataFrame(rows, CONTACT).coalesce(1).write.mode("append").parquet(str(path))


def in_time_order(rows, parts):
    rows = sorted(rows, key=lambda r: (r[1], r[2]))
    size = -(-len(rows) // parts)
    return [rows[i:i + size] for i in range(0, len(rows), size)]


def passed_at(spark, path):
    return told(spark.read.parquet(path).collect())


def test_gate_table_resumes_and_replays(spark, tmp_path):
    rows = contacts_of(4, 200)
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def run(checkpoint, files=1):
        stream = spark.readStream.schema(CONTACT).option("maxFilesPerTrigger", files).parquet(str(src))
        contacts.start_gate(stream, ["acm_id"], "contacted_at", "event_id", "gap_days", out, checkpoint).awaitTermination()
        return passed_at(spark, out)

    for part in in_time_order(rows, 3):
        land(spark, src, part)
        passed = run(state)
    assert passed == gate(rows)
    # A lost checkpoint replays everything over the existing folders, whatever the boundaries of its batches.
    assert run(str(tmp_path / "fresh"), 2) == gate(rows)
    assert run(str(tmp_path / "again"), 3) == gate(rows)
    more = (1, max(r[1] for r in rows) + timedelta(days=30), 7777, 14)
    land(spark, src, [more])
    assert run(str(tmp_path / "again"), 3) == gate([*rows, more])


def test_late_contacts_do_not_pass_once_a_later_one_has(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    for part in ([(1, T0, 1, 14), (2, T0, 2, 14)], [(1, T0 - timedelta(days=60), 3, 14), (3, T0 - timedelta(days=60), 4, 14)], [(1, T0 + timedelta(days=15), 5, 14)]):
        land(spark, src, part)
        contacts.start_gate(stream_of(spark, src), ["acm_id"], "contacted_at", "event_id", "gap_days", out, state).awaitTermination()
    assert [e for *_, e in passed_at(spark, out)] == [1, 5, 2, 4]


def test_contact_state_keeps_the_latest(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    for part in ([(1, T0, 0, 0), (2, T0, 1, 0)], [(1, T0 + timedelta(days=1), 2, 0), (2, T0 - timedelta(days=1), 3, 0)]):
        land(spark, src, part)
        contacts.start_contact_state(stream_of(spark, src), "acm_id", "contacted_at", out, state).awaitTermination()
    log = contact_log.read_contacts(spark, out, "acm_id", "contacted_at", stream_of(spark, src).schema["acm_id"].dataType)
    assert {r.acm_id: r.contacted_at for r in log.collect()} == {1: T0 + timedelta(days=1), 2: T0}


def test_redelivered_clicks_are_kept_once(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    for part in range(2):
        write(src, f"{part}.json", [click(100 - n, age=part * 60 + n) for n in range(20)] + [click(2, value="9")])
        clicks.start_deliveries(clicks.read_clicks(spark, str(src)), out, state, within_minutes=60).awaitTermination()
    kept = spark.read.parquet(out).collect()
    # The copy that arrived first, not whichever a task met first.
    assert sorted((r.click_id, r.arrived_at) for r in kept) == [(2, T0), (100, T0)]
    clicks.start_deliveries(clicks.read_clicks(spark, str(src)), out, str(tmp_path / "fresh"), within_minutes=60).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_a_test_click_without_ids_keeps_a_row(spark):
    rows = [click(0, "test_upsell_email", ""), click(1, "test_monthly_report", "5"), click(2, "test_upsell_email", "x"), click(3, "send_upsell_email", "y")]
    made = clicks.explode_approvals(clicks.route_clicks(batch(spark, rows))).collect()
    assert sorted((r.click_id, r.acm_id, r.bulk_size) for r in made) == [(0, None, 0), (1, 5, 1)]


def test_approval_stream_end_to_end(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    day = timedelta(days=1)
    batches = [
        [click(1, "send_all_upsell", "1,2", T0), click(2, "send_monthly_report", "1", T0), click(3, "test_upsell_email", "3", T0), click(4, value="4", age=301)],
        [click(5, value="1", at=T0 + 14 * day), click(6, "send_monthly_report", "1", T0 + 14 * day + timedelta(seconds=1))],
        [click(7, value="1", at=T0 + 14 * day + timedelta(seconds=1)), click(8, "send_monthly_report", "1", T0 + 26 * day)],
    ]
    for n, rows in enumerate(batches):
        write(src, f"{n}.json", rows)
        approvals.start_approvals(clicks.read_clicks(spark, str(src)), out, state).awaitTermination()
    passed = spark.read.schema(approvals.PASSED).parquet(out)
    assert sorted((r.workflow, r.acm_id, r.click_id) for r in passed.collect()) == [
        ("monthly_report", 1, 2), ("monthly_report", 1, 8), ("weekly_upsell", 1, 1), ("weekly_upsell", 1, 7), ("weekly_upsell", 2, 1),
    ]
    box = approvals.approvals_outbox(spark, out)
    assert box.filter((F.col("kind") == "approval") & (F.col("run_date") == "2025-06-27")).count() == 1


def triage_rows():
    """Clicks by the reason they are of no use for; None for good ones."""
    broken = {"form_body": "payload=%7Bbroken"}
    return [
        (None, click(0, value="1,2")), (None, click(1, "test_upsell_email", "")), ("stale", click(2, age=301)), ("stale", {**click(3), "request_ts": "soon"}),
        ("stale", {**click(4), "request_ts": None}), ("no payload", {**click(5), "form_body": "x=1"}), ("no payload", {**click(6), "form_body": None}),
        ("unreadable", {**click(7), **broken}), ("unreadable", {**click(8), "form_body": "payload=%zz"}), ("no action", click(9, kind="url_verification")),
        ("no action", click(10, actions=[])), ("no action", click(11, payload="{}")), ("no action", click(12, payload="[1]")), ("unknown button", click(13, "other")),
        ("unknown button", click(14, actions=[{"value": "1"}])), ("no ids", click(15, value="")), ("no ids", click(16, actions=[{"action_id": "send_all_upsell"}])),
    ]


def test_every_click_is_good_or_has_a_reason(spark):
    rows = batch(spark, [r for _, r in triage_rows()])
    rows = rows.unionByName(batch(spark, [click(17)]).withColumn("arrived_at", F.lit(None).cast("timestamp_ntz")))
    told = {r.click_id: r.reason for r in clicks.with_reason(rows).collect()}
    assert told == {r["click_id"]: reason for reason, r in triage_rows()} | {17: "no arrival"}
    assert set(told.values()) - {None} == set(clicks.CLICK_REASONS) - {"repeated"}
    good = {r.click_id for r in clicks.route_clicks(clicks.fresh_clicks(rows)).collect()}
    assert good == {k for k, reason in told.items() if reason is None}


def test_rows_in_are_rows_out(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    rows = [r for reason, r in triage_rows()] + [click(0, value="1,2")] * 2 + [click(20, value=" 5, x,,7.5"), click(21, value="1", at=T0 + timedelta(days=1))]
    write(src, "0.json", rows)
    write(src, "1.json", [click(30, value="1,2"), click(31, value="9", at=T0 + timedelta(days=20))])
    approvals.start_approvals(clicks.read_clicks(spark, str(src), max_files=1), out, state).awaitTermination()
    found = approvals.rejected(spark, out).groupBy("reason").agg(F.sum("rows").alias("n")).collect()
    reasons = {r.reason: r.n for r in found}
    # Clicks: every one is a delivery kept once or a reject. Click 30 repeats the delivery of click 0.
    kept = spark.read.parquet(f"{out}-deliveries").count()
    assert kept + sum(n for r, n in reasons.items() if r in clicks.CLICK_REASONS) == len(rows) + 2
    assert reasons["repeated"] == 3 and reasons["stale"] == 3 and reasons["unreadable"] == 2
    # Ids: 1, 2, 5, 9 pass, 1 again is held back, x and 7.5 are none.
    assert sorted(r.acm_id for r in spark.read.schema(approvals.PASSED).parquet(out).collect()) == [1, 2, 5, 9]
    assert reasons["held back"] == 1 and reasons["unusable id"] == 2
    # A checkpoint lost: nothing passes twice.
    approvals.start_approvals(clicks.read_clicks(spark, str(src), max_files=1), out, str(tmp_path / "again")).awaitTermination()
    assert sorted(r.acm_id for r in spark.read.schema(approvals.PASSED).parquet(out).collect()) == [1, 2, 5, 9]


def test_a_run_takes_approvals_once(spark, tmp_path):
    src, path, box, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "box"), str(tmp_path / "state")

    def arrive(name, rows):
        write(src, name, rows)
        approvals.start_approvals(clicks.read_clicks(spark, str(src), max_files=1), path, state).awaitTermination()

    assert approvals.claim_approvals(spark, path, box, "a") is None
    arrive("0.json", [click(1, "send_all_upsell", "1,2"), click(2, "test_monthly_report", "7"), click(3, "test_upsell_email", "")])
    first = approvals.claim_approvals(spark, path, box, "a")
    expected = [("monthly_report", True, 7), ("weekly_upsell", False, 1), ("weekly_upsell", False, 2)]
    rows = {(r.workflow, r.test_mode, r.acm_id) for r in first.ids.collect()}
    assert first.run == "a" and rows == {*expected, ("weekly_upsell", True, None)}
    # More arrives, and the job breaks off before it publishes: the next one gets what the first had, under its name.
    arrive("1.json", [click(4, "send_monthly_report", "1", T0 + timedelta(days=1))])
    again = approvals.claim_approvals(spark, path, box, "b")
    assert again.run == "a" and {(r.workflow, r.test_mode, r.acm_id) for r in again.ids.collect()} == rows
    assert runs.publish(spark, box, "a", mails=spark.range(2)) and not runs.publish(spark, box, "a", mails=spark.range(5))
    second = approvals.claim_approvals(spark, path, box, "b")
    assert second.run == "b" and [tuple(r) for r in second.ids.collect()] == [("monthly_report", False, 1)]
    assert runs.publish(spark, box, "b", mails=spark.range(3))
    assert approvals.claim_approvals(spark, path, box, "c") is None
    assert runs.read_published(spark, box, "mails", spark.range(1).schema).groupBy("run").count().orderBy("run").collect() == [("a", 2), ("b", 3)]


def test_a_run_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    box, kinds = str(tmp_path / "box"), spark.range(1).schema

    def seen():
        return [sorted(r.id for r in runs.read_published(spark, box, table, kinds).collect()) for table in ("mails", "sent")]

    assert seen() == [[], []]
    runs.publish(spark, box, "1", mails=spark.range(2), sent=spark.range(1))
    # Breaks off after the first table; the tables of the broken run are there and not seen.
    broken = spark.range(3).withColumn("id", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        runs.publish(spark, box, "2", mails=spark.range(9), sent=broken)
    assert spark.read.parquet(f"{box}/mails").count() == 11 and seen() == [[0, 1], [0]]
    runs.publish(spark, box, "2", mails=spark.range(5, 6), sent=spark.range(7, 8))
    assert seen() == [[0, 1, 5], [0, 7]]


def test_approved_clicks_are_mailed_once(spark, tmp_path):
    src, path, box, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "box"), str(tmp_path / "state")
    write(src, "0.json", [click(1, "send_all_upsell", "1,2"), click(2, "test_upsell_email", "2"), click(3, "send_monthly_report", "5")])
    approvals.start_approvals(clicks.read_clicks(spark, str(src)), path, state).awaitTermination()
    asked = []

    def mailer(ids, test):
        asked.append((sorted(r.acm_id for r in ids.collect()), test))
        blank = {c: F.lit(None) for c in ("list_no", "pos")} | {"subject": F.lit("s"), "html": F.lit("h")}
        to = F.lit("me@example.com") if test else F.concat(F.lit("host"), F.col("acm_id").cast("string"))
        return ids.withColumns(blank | {"recipient": to, "outcome": F.when(F.col("acm_id") == 1, "skip").otherwise("success")})

    def run(name):
        return mail_approved(spark, path, box, name, T0, {"weekly_upsell": mailer, "monthly_report": mailer})

    assert run("a") == "a" and run("b") is None
    assert asked == [([1, 2], False), ([2], True), ([5], False)]
    mails = published_mails(spark, box).collect()
    assert sorted((r.workflow, r.kind, r.acm_id, r.recipient, r.outcome) for r in mails) == [
        ("monthly_report", "mail", 5, "host5", "success"), ("weekly_upsell", "mail", 1, "host1", "skip"),
        ("weekly_upsell", "mail", 2, "host2", "success"), ("weekly_upsell", "test_mail", 2, "me@example.com", "success"),
    ]
    # What was mailed is a contact; tests and what was held back are none.
    assert [tuple(r) for r in sent_log(spark, box, "weekly_upsell").collect()] == [("host2", T0)]
