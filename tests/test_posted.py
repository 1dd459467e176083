from __future__ import annotations

from datetime import timedelta

import pytest
from conftest import AS_OF, days_ago
from pyspark.sql import functions as F

from staylift.plans import approved, posted, weekly
from staylift.schemas import COPY
from staylift.sources.runs import publish


def rows(df) -> list:
    return sorted(df.select(*sorted(df.columns)).collect(), key=str)


@pytest.fixture
def week(spark, world, rules):
    acms = [world.acm(name=f"[제주/펜션] {k}", email=f"h{k}@example.com") for k in range(4)]
    for k, acm in enumerate(acms):
        world.book(acm, 5 + k)
    world.advert(acms[3], "0.10", started=days_ago(3))
    t = world.tables(spark)
    copies = spark.createDataFrame([(acm, "안녕하세요", "본문") for acm in acms], COPY)
    return acms, t, copies, weekly.weekly_targets(t, AS_OF, rules)


def test_a_report_and_what_it_showed_appear_together(spark, week, rules, tmp_path):
    acms, t, copies, targets = week
    box = str(tmp_path / "box")
    assert posted.shown_log(spark, box).count() == 0 == posted.posted_reports(spark, box).count()
    # The first run breaks off while its contacts are written, the messages being there already.
    broken = targets.withColumn("acm_id", F.when(F.col("list_no") < 9, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("acm_id")))
    messages = weekly.weekly_report(targets, copies, AS_OF, rules)
    with pytest.raises(Exception, match="lost"):
        publish(spark, box, "week 1", reports=messages, shown=weekly.shown_contacts(broken, AS_OF))
    assert spark.read.parquet(f"{box}/reports").count() > 0
    assert posted.shown_log(spark, box).count() == 0 == posted.posted_reports(spark, box).count()
    # The same run again: seen whole, and once.
    assert posted.post_weekly_report(spark, box, "week 1", targets, copies, AS_OF, rules)
    assert not posted.post_weekly_report(spark, box, "week 1", targets.limit(0), copies, AS_OF, rules)
    assert rows(posted.posted_reports(spark, box)) == rows(messages)
    assert rows(posted.shown_log(spark, box)) == [(acm, AS_OF) for acm in sorted(acms)]
    # Three days later nobody is left to show, eight days later all are.
    for days, left in ((3, 0), (8, 4)):
        later = AS_OF + timedelta(days=days)
        again = weekly.weekly_targets(t, later, rules, shown_log=posted.shown_log(spark, box))
        assert again.count() == left


def test_a_mailing_and_its_contacts_appear_together(spark, week, tmp_path):
    acms, _, copies, targets = week
    box = str(tmp_path / "box")
    log = spark.createDataFrame([("h1@example.com", days_ago(2))], "email STRING, last_sent TIMESTAMP_NTZ")
    mailed = weekly.weekly_mailing(targets, copies, log, "{{host_name}}", AS_OF)
    assert posted.post_mailing(spark, box, "mail 1", mailed, AS_OF)
    assert not posted.post_mailing(spark, box, "mail 1", mailed, AS_OF)
    kinds = {(r.kind, r.acm_id, r.outcome) for r in approved.published_mails(spark, box).collect()}
    assert {k for k in kinds if k[0] == "mail"} == {("mail", a, "skip" if k == 1 else "success") for k, a in enumerate(acms)}
    assert ("notice", acms[1], None) in kinds
    assert rows(posted.sent_log(spark, box)) == [(f"h{k}@example.com", AS_OF) for k in (0, 2, 3)]
    # A mailing after it holds them back; a test mailing leaves no contact.
    second = weekly.weekly_mailing(targets, copies, posted.sent_log(spark, box), "{{host_name}}", AS_OF + timedelta(days=1), test_to="me@example.com")
    assert posted.post_mailing(spark, box, "mail 2", second, AS_OF + timedelta(days=1), test_to="me@example.com")
    assert sorted((r.acm_id, r.outcome) for r in second.collect()) == [(a, "success" if k == 1 else "skip") for k, a in enumerate(acms)]
    assert len(rows(posted.sent_log(spark, box))) == 3
