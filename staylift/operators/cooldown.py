"""Contact-frequency rules.

A contact blocks only while it is recent, so each rule first cuts the log to the recent stamps (a
filter the scan can use) and then joins what is left.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylift.config import at

UNKNOWN_DATE = "알 수 없음"


def _before(as_of: datetime, days: int) -> Column:
    return at(as_of) - F.expr(f"INTERVAL '{days}' DAY")


def not_recently_shown(df: DataFrame, log: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Drop targets shown less than ``days`` ago; exactly ``days`` passes."""
    recent = log.filter(F.col("last_shown") > _before(as_of, days)).select("acm_id").distinct()
    return df.join(recent, "acm_id", "left_anti")


def _recently_sent(log: DataFrame, as_of: datetime, days: int) -> DataFrame:
    """Latest stamp of the addresses still blocked; exactly ``days`` old still blocks."""
    return (
        log.filter(F.col("last_sent") >= _before(as_of, days))
        .groupBy(F.col("email").alias("host_email"))
        .agg(F.max("last_sent").alias("last_sent"))
    )


def pending(df: DataFrame, log: DataFrame, as_of: datetime, days: int) -> DataFrame:
    """Targets with an address that was last mailed more than ``days`` ago, or never."""
    reachable = df.filter(F.col("host_email") != "")
    return reachable.join(_recently_sent(log, as_of, days).select("host_email"), "host_email", "left_anti")


def blocked(df: DataFrame, log: DataFrame, as_of: datetime, days: int) -> DataFrame:
    """The complement of ``pending``, with the date from which the host may be mailed again."""
    joined = df.join(_recently_sent(log, as_of, days), "host_email", "left")
    return (
        joined.filter(F.col("last_sent").isNotNull() | F.col("host_email").isNull() | (F.col("host_email") == ""))
        .withColumn("next_available", next_available(F.col("last_sent"), days))
        .drop("last_sent")
    )


def next_available(last_sent: Column, days: int) -> Column:
    day = F.date_format(last_sent + F.expr(f"INTERVAL '{days}' DAY"), "yyyy-MM-dd")
    return F.coalesce(day, F.lit(UNKNOWN_DATE))


def with_outcome(
    df: DataFrame, log: DataFrame, as_of: datetime, days: int, *, dry_run: bool = False
) -> DataFrame:
    """``outcome`` skip (cooling down or no address) or success, in one join instead of two lists.

    What the outcome of a mail turns out to be is for ``with_deliveries`` to say.

    ``next_available`` is set for skipped rows; a dry run knows no cool-down beyond the as-of moment
    and reports no dates.
    """
    span = 0 if dry_run else days
    joined = df.join(_recently_sent(log, as_of, span), "host_email", "left")
    has_address = F.coalesce(F.col("host_email") != "", F.lit(False))
    skip = F.col("last_sent").isNotNull() | ~has_address
    date = F.lit(None).cast("string") if dry_run else F.when(skip, next_available(F.col("last_sent"), span))
    return joined.withColumns(
        {
            "outcome": F.when(skip, "skip").otherwise("success"),
            "next_available": date,
        }
    ).drop("last_sent")


def with_deliveries(mailed: DataFrame, results: DataFrame) -> DataFrame:
    """Turn mails that delivery reports as not ``delivered`` into outcome fail.

    ``results`` has acm_id, recipient, delivered; of several reports on a mail one success is enough. A mail without a
    report keeps its outcome, and what was skipped stays skipped.
    """
    sent = results.groupBy("acm_id", "recipient").agg(F.max("delivered").alias("delivered"))
    joined = mailed.join(sent, ["acm_id", "recipient"], "left")
    failed = (F.col("outcome") == "success") & ~F.coalesce("delivered", F.lit(True))
    return joined.withColumn("outcome", F.when(failed, "fail").otherwise(F.col("outcome"))).drop("delivered")


def batch_outcome(df: DataFrame) -> DataFrame:
    return df.groupBy("outcome").agg(F.count(F.lit(1)).alias("mails"))


def mark_shown(shown: DataFrame, as_of: datetime) -> DataFrame:
    """Log rows for every candidate of a posted report, carded or not, under one stamp."""
    return shown.select("acm_id", at(as_of).alias("last_shown")).distinct()


def mark_sent(mailed: DataFrame, as_of: datetime, test_to: str = "", *, mark_tests: bool = False) -> DataFrame:
    """Log rows for the addresses really used. Test mails count only with ``mark_tests``."""
    sent = mailed.filter(F.col("outcome") == "success")
    if test_to and not mark_tests:
        sent = sent.filter(F.lit(False))
    return sent.select(F.col("recipient").alias("email"), at(as_of).alias("last_sent")).distinct()
