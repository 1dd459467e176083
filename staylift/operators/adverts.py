"""Adverts that run at the as-of moment, and the one that counts per accommodation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylift.config import now_sql


def active_adverts(adverts: DataFrame, as_of: datetime) -> DataFrame:
    """Paid for and started by ``as_of`` (no start date means unpaid), and open-ended or expiring later."""
    now = now_sql(as_of)
    return adverts.filter(f"success_at <= {now} AND (expiration_at IS NULL OR expiration_at > {now})")


def commission_at_most(adverts: DataFrame, rate: str) -> DataFrame:
    return adverts.filter(f"advert_commission <= CAST('{rate}' AS DECIMAL(4,2))")


def commission_at_least(adverts: DataFrame, rate: str) -> DataFrame:
    return adverts.filter(f"advert_commission >= CAST('{rate}' AS DECIMAL(4,2))")


def advertised_ids(adverts: DataFrame) -> DataFrame:
    """The accommodations behind the adverts, once each: semi and anti joins then move one row per key."""
    return adverts.select(F.col("accommodation_id").alias("acm_id")).distinct()


def top_tier(adverts: DataFrame) -> DataFrame:
    """Per accommodation its highest commission; equal rates under different names all stay.

    Duplicates combine before the shuffle. The ``rank = 1`` filter is applied map-side first
    (window group limit), so an accommodation with very many adverts sends only its best rows.
    """
    best = Window.partitionBy("accommodation_id").orderBy(F.col("advert_commission").desc())
    return (
        adverts.select("accommodation_id", "advert_name", "advert_commission")
        .dropDuplicates()
        .withColumn("tier_rank", F.rank().over(best))
        .filter("tier_rank = 1")
        .select(F.col("accommodation_id").alias("acm_id"), "advert_name", "advert_commission")
    )


def latest_advert(adverts: DataFrame) -> DataFrame:
    """Per accommodation its most recent advert; ties on the date that differ in name or rate all stay.

    ``copies`` counts identical rows, for the option that lets duplicates weigh on sums.
    """
    recent = Window.partitionBy("accommodation_id").orderBy(F.col("success_at").desc())
    return (
        adverts.groupBy("accommodation_id", "advert_name", "advert_commission", "success_at")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("date_rank", F.rank().over(recent))
        .filter("date_rank = 1")
        .select(F.col("accommodation_id").alias("acm_id"), "advert_name", "advert_commission", "success_at", "copies")
    )
