"""Grades, offers and performance classes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylift.config import Packages
from staylift.schemas import RATE

# Least bookings per grade; fewer still count as D.
GRADE_FLOORS = [("A", 10), ("B", 3), ("C", 2)]
GROWTH, DECLINE = 0.2, -0.2
PRICE_HIGH_FACTOR = 1.3


def _first_of(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    head, *rest = cases
    return reduce(lambda chain, case: chain.when(*case), rest, F.when(*head)).otherwise(otherwise)


def grade(res: Column) -> Column:
    return _first_of([(res >= floor, F.lit(name)) for name, floor in GRADE_FLOORS], F.lit("D"))


def next_package(rate: Column, packages: Packages) -> Column:
    """struct(name, rate) of the package to offer, NULL when the rate has none (0.00 and 0.30 included)."""
    key = F.round(rate, 2).cast(RATE)
    cases = [
        (key.eqNullSafe(F.lit(current).cast(RATE)), F.struct(F.lit(name).alias("name"), F.lit(to).alias("rate")))
        for current, name, to in packages.ladder()
    ]
    return _first_of(cases, F.lit(None))


def extra_revenue(gmv: Column, from_rate: Column, to_rate: Column) -> Column:
    """Truncated, in DOUBLE arithmetic: 100000 at 0.10 -> 0.15 gives 4999."""
    return (gmv * (to_rate - F.coalesce(from_rate.cast("double"), F.lit(0.0)))).cast("long")


def score_targets(targets: DataFrame, target_type: str, packages: Packages) -> DataFrame:
    """Add grade, offer and expected extra revenue; drop targets that have no next package."""
    if "advert_commission" not in targets.columns:
        targets = targets.withColumns({"advert_name": F.lit(None).cast("string"), "advert_commission": F.lit(None).cast(RATE)})
    rate = F.col("advert_commission")
    offered = targets.withColumn("offer", next_package(rate, packages)).filter(F.col("offer").isNotNull())
    return offered.withColumns(
        {
            "grade": grade(F.col("res_90d")),
            "target_type": F.lit(target_type),
            "rec_package": F.col("offer.name"),
            "rec_rate": F.col("offer.rate"),
            "extra_rev_90d": extra_revenue(F.col("gmv_90d"), rate, F.col("offer.rate")),
        }
    ).drop("offer")


def change_ratio(this: Column, last: Column) -> Column:
    return F.try_divide((this - last).cast("double"), last.cast("double"))


def classify(this: Column, last: Column) -> Column:
    change = change_ratio(this, last)
    return (
        F.when(this == 0, "zero").when(last == 0, "new")
        .when(change >= GROWTH, "growth").when(change <= DECLINE, "poor")
        .otherwise("stable")
    )


def change_pct(this: Column, last: Column) -> Column:
    return F.when(last == 0, F.lit(0.0)).otherwise(change_ratio(this, last) * 100)


def price_high(host_price: Column, region_price: Column) -> Column:
    return (region_price > 0) & (host_price > 0) & (host_price > region_price * PRICE_HIGH_FACTOR)


def with_baseline(df: DataFrame, baseline: DataFrame) -> DataFrame:
    """Look up the region's figures; an unknown or empty region has zeros."""
    figures = [c for c in baseline.columns if c != "region"]
    joined = df.join(baseline, "region", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in figures})


def score_hosts(hosts: DataFrame, baseline: DataFrame) -> DataFrame:
    this, last = F.col("res_this_month"), F.col("res_last_month")
    host_price = F.coalesce(F.try_divide(F.col("gmv_this_month").cast("double"), this.cast("double")), F.lit(0.0))
    region_price = F.col("avg_price_per_res")
    scored = with_baseline(hosts, baseline).withColumns(
        {
            "perf": classify(this, last),
            "change_pct": F.round(change_pct(this, last), 1),
            "host_price_per_res": host_price.cast("long"),
            "region_avg_price": region_price.cast("long"),
            "price_high": price_high(host_price, region_price),
            "region_avg_res": F.round("avg_res", 1),
            "consecutive_zero": (this == 0) & (last == 0),
        }
    )
    return scored.drop("avg_res", "avg_price_per_res", "ad_acm_cnt")


def needs_direct_call(hosts: DataFrame) -> DataFrame:
    return hosts.filter("consecutive_zero")


def upgrade_offer(perf: Column, rate: Column, packages: Packages) -> Column:
    """struct(name, benefits) for growing hosts below the top tier, else NULL."""
    key = F.round(rate, 2).cast(RATE)
    cases = [
        ((perf == "growth") & (key == F.lit(current).cast(RATE)), F.struct(F.lit(name).alias("name"), F.lit(extra).alias("benefits")))
        for current, name, extra in packages.upgrade_offers()
    ]
    return _first_of(cases, F.lit(None))


def wants_price_advice(perf: Column, high: Column, region_price: Column) -> Column:
    return high & perf.isin("poor", "zero") & (region_price > 0)


def shows_package(perf: Column) -> Column:
    """Hosts without a booking last month see no package or region line."""
    return perf != "zero"
