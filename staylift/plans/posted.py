"""Reports and mailings as runs: messages and the contacts they make become visible together, or not at all.

A run that breaks off anywhere shows nothing and is repeated under its name; one that is published is not done again. So
no accommodation counts as shown by a report that was never posted, and no posted one is shown again the next week.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylift.config import Rules
from staylift.operators import cooldown
from staylift.plans import monthly, weekly
from staylift.plans.approved import SENT
from staylift.schemas import SHOWN_LOG
from staylift.sources.outbox import OUTBOX
from staylift.sources.runs import publish, read_published
from staylift.sources.workspace import settle


def post_weekly_report(
    spark: SparkSession, outbox: str, run: str, targets: DataFrame, copies: DataFrame, as_of: datetime, rules: Rules, *,
    order: str | None = None, limited: bool = True,
) -> bool:
    """Publish the review report and, with it, its candidates as shown. False if the run is published already."""
    messages = weekly.weekly_report(targets, copies, as_of, rules, order=order, limited=limited)
    return publish(spark, outbox, run, reports=messages, shown=weekly.shown_contacts(targets, as_of))


def post_monthly_report(
    spark: SparkSession, outbox: str, run: str, hosts: DataFrame, copies: DataFrame, as_of: datetime, *,
    order: str | None = None, limited: bool = True,
) -> bool:
    """Publish the performance report; it shows nobody an offer, so it leaves no contacts."""
    return publish(spark, outbox, run, reports=monthly.monthly_report(hosts, copies, as_of, order=order, limited=limited))


def post_mailing(
    spark: SparkSession, outbox: str, run: str, mailed: DataFrame, as_of: datetime, workflow: str = weekly.WORKFLOW, *, test_to: str = "",
    mark_tests: bool = False,
) -> bool:
    """Publish a mailing with its notices and, with it, the addresses it was sent to. Mails are rendered once."""
    mailed = settle(mailed)
    sent = cooldown.mark_sent(mailed, as_of, test_to, mark_tests=mark_tests).withColumn("workflow", F.lit(workflow))
    return publish(spark, outbox, run, mails=weekly.mailing_outbox(mailed, as_of, workflow), sent=sent)


def posted_reports(spark: SparkSession, outbox: str) -> DataFrame:
    """All rows of published reports."""
    return read_published(spark, outbox, "reports", OUTBOX).select(*OUTBOX.names)


def shown_log(spark: SparkSession, outbox: str) -> DataFrame:
    """When each accommodation was last shown by a published report."""
    return read_published(spark, outbox, "shown", SHOWN_LOG).groupBy("acm_id").agg(F.max("last_shown").alias("last_shown"))


def sent_log(spark: SparkSession, outbox: str) -> DataFrame:
    """When each address was last mailed by published runs, whatever the workflow."""
    return read_published(spark, outbox, "sent", SENT).groupBy("email").agg(F.max("last_sent").alias("last_sent"))
