"""From approvals to mails: what was approved since the last run, mailed once."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylift.operators import cooldown
from staylift.sources.outbox import OUTBOX, as_outbox
from staylift.sources.runs import publish, read_published
from staylift.sources.workspace import scratch, settle
from staylift.streaming.approvals import claim_approvals

SENT = T.StructType([T.StructField("email", T.StringType()), T.StructField("last_sent", T.TimestampNTZType()), T.StructField("workflow", T.StringType())])
#: Given approved ids and whether they come from test clicks, the mails with their outcome (see ``weekly_mailing``).
Mailer = Callable[[DataFrame, bool], DataFrame]


def mail_approved(spark: SparkSession, approvals: str, outbox: str, run: str, as_of: datetime, mailers: dict[str, Mailer]) -> str | None:
    """Mail what was approved since the last run, by the workflow's mailer, and publish mails and contacts as one run.

    Test clicks get mails of their own (kind ``test_mail``) and leave no contact. Returns the run's name: that of an earlier
    run if one broke off between claim and publication, which is done again under its own name; None if nothing was
    approved. Mails and contacts become visible together, by ``read_published``.
    """
    with scratch(spark):
        claim = claim_approvals(spark, approvals, outbox, run)
        if claim is None:
            return None
        mails, contacts = [spark.createDataFrame([], OUTBOX)], [spark.createDataFrame([], SENT)]
        for workflow, mailer in mailers.items():
            for test in (False, True):
                ids = claim.ids.filter((F.col("workflow") == workflow) & (F.col("test_mode") == test)).select("acm_id")
                if ids.isEmpty():
                    continue
                mailed = settle(mailer(ids, test))
                kind = F.lit("test_mail" if test else "mail")
                rows = mailed.select(kind.alias("kind"), "list_no", "pos", "acm_id", "recipient", "subject", F.col("html").alias("body"), "outcome")
                mails.append(as_outbox(rows, as_of, workflow))
                if not test:
                    contacts.append(cooldown.mark_sent(mailed, as_of).withColumn("workflow", F.lit(workflow)))
        publish(spark, outbox, claim.run, mails=reduce(DataFrame.unionByName, mails), sent=reduce(DataFrame.unionByName, contacts))
        return claim.run


def published_mails(spark: SparkSession, outbox: str) -> DataFrame:
    """All mails of published runs, as outbox rows."""
    return read_published(spark, outbox, "mails", OUTBOX).select(*OUTBOX.names)


def sent_log(spark: SparkSession, outbox: str, workflow: str) -> DataFrame:
    """When each address was last mailed by published runs."""
    rows = read_published(spark, outbox, "sent", SENT).filter(F.col("workflow") == workflow)
    return rows.groupBy("email").agg(F.max("last_sent").alias("last_sent"))
