import json
from datetime import datetime

import pytest
from conftest import AS_OF, days_ago
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylift import load_tables
from staylift.functions.clock import wall_micros
from staylift.plans import weekly
from staylift.sources import contact_log, outbox, tables, workspace


def test_load_tables_round_trip_and_checks(spark, world, rules, tmp_path):
    a = world.acm()
    world.book(a, 2)
    t = world.tables(spark)
    for name in tables.NATIVE:
        getattr(t, name).write.parquet(str(tmp_path / name))
    loaded = load_tables(spark, str(tmp_path))
    assert weekly.no_ad_targets(loaded, AS_OF, rules).collect() == weekly.no_ad_targets(t, AS_OF, rules).collect()
    with pytest.raises(ValueError, match="rooms.*accommodation_id"):
        tables.Tables(**{**vars(loaded), "rooms": loaded.rooms.drop("accommodation_id")})


def test_bucketed_catalogue_joins_without_moving_bookings(spark, world, rules):
    for i in range(20):
        world.book(world.acm(), 1 + i % 3)
    t = world.tables(spark)
    spark.sql("CREATE DATABASE IF NOT EXISTS lift")
    try:
        tables.save_bucketed(t, "lift", 4)
        stored = tables.load_catalogue(spark, "lift")
        found = weekly.no_ad_targets(stored, AS_OF, rules)
        assert found.collect() == weekly.no_ad_targets(t, AS_OF, rules).collect()
        from staylift.operators.bookings import booked_in_window

        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = booked_in_window(stored.reservations, stored.rooms, AS_OF, rules)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(acm_id" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE lift CASCADE")


def test_json_log_import_and_missing_file(spark, tmp_path):
    path = tmp_path / "log.json"
    path.write_text(json.dumps({"acms": {"12": "2025-06-01T09:30:00.123456+09:00", "13": "2025-06-01T00:30:00+00:00"}}, indent=2))
    log = contact_log.read_contact_log(spark, str(path), "acms", "acm_id", "last_shown", T.LongType())
    assert {r.acm_id: r.last_shown for r in log.collect()} == {12: datetime(2025, 6, 1, 9, 30, 0, 123456), 13: datetime(2025, 6, 1, 9, 30)}
    none = contact_log.read_contact_log(spark, str(tmp_path / "no.json"), "emails", "email", "last_sent")
    assert none.columns == ["email", "last_sent"] and none.count() == 0


def imported(spark, path):
    rows = contact_log.read_contact_log(spark, str(path), "emails", "email", "last_sent")
    return rows, sorted((r.email, r.last_sent) for r in rows.collect())


@pytest.mark.parametrize("form", [{}, {"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False}])
def test_one_log_is_read_by_many_tasks(spark, tmp_path, form):
    path, at = tmp_path / "log.json", datetime(2025, 6, 1, 9, 30)
    keys = [f"host{n}@example.com" for n in range(500)] + ["é, {x}@b", 'quo"te', "back\\", "a: b}}", "", " 한글 "]
    path.write_text(json.dumps({"emails": {k: "2025-06-01T09:30:00+09:00" for k in keys}}, **form))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows, found = imported(spark, path)
        assert found == sorted((k, at) for k in keys) and rows.rdd.getNumPartitions() > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("text", ['{"emails": {}}', ' {\n "emails" : { } }\n', '{"other": {}}', "{}", '{"emails": null}'])
def test_logs_without_entries(spark, tmp_path, text):
    (tmp_path / "log.json").write_text(text)
    assert imported(spark, tmp_path / "log.json")[1] == []


def test_logs_that_cannot_be_cut_are_parsed_whole(spark, tmp_path):
    at = "2025-06-01T09:30:00+09:00"
    (tmp_path / "log.json").write_text(json.dumps({"emails": {'odd",key': at, "b": at, "c": at}}))
    assert [k for k, _ in imported(spark, tmp_path / "log.json")[1]] == ["b", "c", 'odd",key']
    (tmp_path / "two.json").write_text(json.dumps({"made": "today", "emails": {"a": at, "b": at}}))
    assert [k for k, _ in imported(spark, tmp_path / "two.json")[1]] == ["a", "b"]
    (tmp_path / "three.json").write_text(json.dumps({"emails": {"a": at, "b": at}, "made": "today"}))
    assert [k for k, _ in imported(spark, tmp_path / "three.json")[1]] == ["a", "b"]


def test_contact_table_appends_replaces_and_compacts(spark, tmp_path):
    path = str(tmp_path / "log")
    assert contact_log.read_contacts(spark, path, "email", "last_sent").count() == 0

    def add(batch, *rows):
        contact_log.append_contacts(spark.createDataFrame(list(rows), "email STRING, last_sent TIMESTAMP_NTZ"), path, contact_log.batch_name(batch))

    add(0, ("a", days_ago(9)), ("b", days_ago(8)))
    add(1, ("a", days_ago(1)))
    add(1, ("a", days_ago(2)))
    expected = {"a": days_ago(2), "b": days_ago(8)}
    assert {r.email: r.last_sent for r in contact_log.read_contacts(spark, path, "email", "last_sent").collect()} == expected
    def told(df):
        return {r.email: r.last_sent for r in df.collect()}

    def compact():
        contact_log.compact_contacts(spark, path, "email", "last_sent")
        return sorted(p.name for p in (tmp_path / "log").glob("batch=*"))

    # A read that began before a compaction ends as it began; the next compaction removes what the first one merged.
    began = contact_log.read_contacts(spark, path, "email", "last_sent")
    assert len(compact()) == 3 and told(began) == expected
    assert told(contact_log.read_contacts(spark, path, "email", "last_sent")) == expected
    live = contact_log._live(spark, path, "email", "last_sent", T.StringType())
    assert [r.batch.startswith("merged-") for r in live.select("batch").distinct().collect()] == [True]
    add(2, ("c", days_ago(3)))
    add(0, ("a", days_ago(9)), ("b", days_ago(8)))
    began = contact_log.read_contacts(spark, path, "email", "last_sent")
    assert len(compact()) == 3 and told(began) == expected | {"c": days_ago(3)}
    assert told(contact_log.read_contacts(spark, path, "email", "last_sent")) == expected | {"c": days_ago(3)}
    # Nothing to merge: only what the last one left goes.
    assert len(compact()) == 1 and compact() == compact()
    assert told(contact_log.read_contacts(spark, path, "email", "last_sent")) == expected | {"c": days_ago(3)}


def test_outbox_rewrites_only_its_day(spark, tmp_path):
    path = str(tmp_path / "outbox")

    def rows(day, n):
        df = spark.range(n).selectExpr("id AS acm_id", "'card' AS kind", "'x' AS body")
        return outbox.as_outbox(df, datetime(2025, 6, day), "weekly_upsell")

    outbox.write_outbox(rows(1, 3), path)
    outbox.write_outbox(rows(2, 2), path)
    outbox.write_outbox(rows(1, 1), path)
    stored = outbox.read_outbox(spark, path)
    assert {r.run_date: r.n for r in stored.groupBy("run_date").agg(F.count("*").alias("n")).collect()} == {"2025-06-01": 1, "2025-06-02": 2}
    assert stored.schema.names == outbox.OUTBOX.names


def test_clock_ignores_the_session_zone(spark):
    # 02:30 on the day the clocks go forward in New York does not exist there.
    wall = datetime(2025, 3, 9, 2, 30, 15, 250000)
    df = spark.createDataFrame([(wall,)], "w TIMESTAMP_NTZ")
    expected = int((wall - datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    assert df.select(wall_micros(F.col("w")).alias("m")).first().m == expected


def test_settle_keeps_rows_and_types(spark):
    df = spark.range(5).selectExpr("id", "CAST(0.15 AS DECIMAL(4,2)) AS rate", "TIMESTAMP_NTZ'2025-01-01' AS at")
    stored = workspace.settle(df)
    assert stored.schema.simpleString() == df.schema.simpleString() and stored.count() == 5


def test_scratch_goes_with_the_job(spark, tmp_path):
    with workspace.scratch(spark) as folder:
        stored = workspace.settle(spark.range(5))
        assert stored.inputFiles()[0].removeprefix("file://").startswith(folder.removeprefix("file:")) and stored.count() == 5
        stored.write.parquet(str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(folder)
    assert workspace.new_path(spark, "x").startswith(workspace.shared_folder(spark))
