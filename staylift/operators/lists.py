"""Report lists: order, positions, candidates, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylift.operators.numbering import running_total

# How many targets get copy, a card, or a line in the summary.
CANDIDATES = 30
NO_AD_CARDS = 15
UPGRADE_CARDS = 10
MONTHLY_CARDS = 20
SUMMARY_LINES = 20


def top_by(df: DataFrame, measure: str, limit: int | None) -> DataFrame:
    """Highest first; ties by id, then by advert name, so that a limit always keeps the same rows."""
    ties = ["acm_id"] + [c for c in ("advert_name", "host_phone") if c in df.columns]
    return df if limit is None else df.orderBy(F.col(measure).desc(), *ties).limit(limit)


def report_list(no_ad: DataFrame, upgrade: DataFrame, *, limited: bool = True) -> DataFrame:
    """Both scored lists, one after the other: ``list_no`` 1 or 2, ``pos`` within the list."""
    both = no_ad.withColumn("list_no", F.lit(1)).unionByName(
        upgrade.withColumn("list_no", F.lit(2)), allowMissingColumns=True
    )
    return with_positions(both, limited=limited)


def numbered(df: DataFrame, groups: list[str], order: list, name: str, *, limited: bool) -> DataFrame:
    """Positions from 1. A limited list (a few hundred rows) is numbered in one task, any other by ranges."""
    if limited:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
    return running_total(df, groups, order, F.lit(1), name).withColumn(name, (F.col(name) + 1).cast("int"))


def with_positions(df: DataFrame, *, limited: bool = True) -> DataFrame:
    """``pos`` by grade, then bookings, within each list."""
    ties = [c for c in ("advert_name", "host_phone") if c in df.columns]
    return numbered(df, ["list_no"], ["grade", F.col("res_90d").desc(), "acm_id", *ties], "pos", limited=limited)


def with_overall(targets: DataFrame, *, limited: bool = True) -> DataFrame:
    """``overall`` counts through both lists."""
    return numbered(targets, [], ["list_no", "pos"], "overall", limited=limited)


def candidates(
    targets: DataFrame, limit: int | None = CANDIDATES, grades: tuple[str, ...] | None = None
) -> DataFrame:
    """The targets that get copy: the first in list order, or all of them without a limit."""
    kept = targets if grades is None else targets.filter(F.col("grade").isin(*grades))
    return with_overall(kept if limit is None else kept.orderBy("list_no", "pos").limit(limit), limited=limit is not None)


def first_per_accommodation(targets: DataFrame) -> DataFrame:
    """An accommodation with several equal adverts is listed once per advert; keep its first row."""
    first = Window.partitionBy("acm_id").orderBy("list_no", "pos")
    return targets.withColumn("nth", F.row_number().over(first)).filter("nth = 1").drop("nth")


def split_list(targets: DataFrame, target_type: str) -> DataFrame:
    return targets.filter(F.col("target_type") == target_type)


def histogram(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("targets"))


def perf_buckets(hosts: DataFrame) -> DataFrame:
    """One row: growth, stable (with new), poor (with zero), total."""
    perf = F.col("perf")
    return hosts.agg(
        F.count_if(perf == "growth").alias("growth"),
        F.count_if(perf.isin("stable", "new")).alias("stable"),
        F.count_if(perf.isin("poor", "zero")).alias("poor"),
        F.count(F.lit(1)).alias("total"),
    )


def bulk_ids(listed: DataFrame, order: list[str], *, limited: bool = True, size: int = 500) -> DataFrame:
    """The ids as CSV in list order, at most ``size`` in a row: part (from 1), acm_ids, id_count."""
    placed = numbered(listed.select(*order, "acm_id"), [], [*order, "acm_id"], "nth", limited=limited)
    parts = placed.groupBy(F.ceil(F.col("nth") / size).cast("int").alias("part"))
    ids = F.transform(F.array_sort(F.collect_list(F.struct("nth", "acm_id"))), lambda e: e["acm_id"].cast("string"))
    return parts.agg(F.array_join(ids, ",").alias("acm_ids"), F.count(F.lit(1)).alias("id_count"))


def one_per_host(targets: DataFrame, order: list) -> DataFrame:
    """Option for mailings: only the first accommodation of each address; rows without one all stay."""
    first = Window.partitionBy(F.coalesce(F.nullif("host_email", F.lit("")), F.col("acm_id").cast("string"))).orderBy(*order)
    return targets.withColumn("nth", F.row_number().over(first)).filter("nth = 1").drop("nth")
