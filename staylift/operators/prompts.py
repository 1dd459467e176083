"""What the copy generator is asked for: an instruction, the facts, and how to answer. One text per target, host or report.

The generator itself is the user's: apply any ``mapInPandas`` function to the ``prompt`` column and
feed its ``response`` column to ``parse_copy``. All wording can be replaced by the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylift.config import Packages, Rules
from staylift.functions import formats as fmt
from staylift.functions.text import facts
from staylift.operators.lists import SUMMARY_LINES, perf_buckets
from staylift.operators.scoring import shows_package, upgrade_offer, wants_price_advice

ANSWER = 'Answer with one JSON object whose keys are "subject" and "body", plain text only.'
OFFER_GUIDANCE = f"{ANSWER} Stay under 500 characters. Quote the bookings. Mention the neighbours that advertise, not how they do."
REPORT_GUIDANCE = f"{ANSWER} Stay under 600 characters. Quote the bookings. Suggest, do not demand."
TARGETS_GUIDANCE = "Open with the totals, mark grade A as this week's calls, give each line a reason to call, stay under 700 characters."
MONTH_GUIDANCE = "Two or three sentences. Where bookings are few or missing, look at prices and quality."
TONES = {
    "growth": "Congratulate, and say in passing that a higher tier can carry the growth on.",
    "stable": "Encourage, with one idea for the coming season.",
    "poor": "Show understanding, look for outside reasons first, then suggest better prices, pictures or texts.",
    "zero": "Be warm and plain; suggest prices, the first picture, the text and quicker answers. No word on adverts, tiers or rates.",
    "new": "Welcome to the first month; figures are still coming in; one idea for a good first impression.",
}


def _won(amount: Column) -> Column:
    return F.concat(fmt.thousands(amount), F.lit(" won"))


def _tier(name: Column, rate: Column) -> Column:
    return F.format_string("%s at %d%%", name, fmt.rate_percent(rate))


def _booked(bookings: Column, value: Column) -> Column:
    return F.concat(bookings.cast("string"), F.lit(" for "), _won(value))


def upsell_prompts(targets: DataFrame, rules: Rules, guidance: str = OFFER_GUIDANCE) -> DataFrame:
    """acm_id, prompt; ``targets`` are scored and carry the region's ``ad_acm_cnt``."""
    package = F.col("rec_package")
    known = facts(
        ("stay", F.col("acm_name")),
        ("host", F.col("host_name")),
        ("tier now", _tier(F.coalesce("advert_name", F.lit("none")), F.col("advert_commission"))),
        ("booked in 90 days", _booked(F.col("res_90d"), F.col("gmv_90d"))),
        ("neighbours that advertise", F.col("ad_acm_cnt")),
        ("tier to offer", _tier(package, F.col("rec_rate"))),
        ("what it brings", fmt.lookup(package, rules.packages.benefits(), "")),
        ("more to expect in 90 days", _won(F.col("extra_rev_90d"))),
    )
    prompt = F.concat_ws("\n\n", F.lit(f"Offer the host below a better place, in the name of {rules.sender_team}."), known, F.lit(guidance))
    return targets.select("acm_id", prompt.alias("prompt"))


def price_advice(host_price: Column, region_price: Column) -> Column:
    return facts(("own price per booking", _won(host_price)), ("price of neighbours that advertise", _won(region_price)))


def report_prompts(hosts: DataFrame, month: Column, rules: Rules, guidance: str = REPORT_GUIDANCE) -> DataFrame:
    """acm_id, advert_name, prompt; parts that do not apply have no line."""
    perf = F.col("perf")
    offer = upgrade_offer(perf, F.col("advert_commission"), rules.packages)
    advised = wants_price_advice(perf, F.col("price_high"), F.col("region_avg_price"))
    known = facts(
        ("stay", F.col("acm_name")),
        ("host", F.col("host_name")),
        ("class", perf),
        ("tier", _tier(F.col("advert_name"), F.col("advert_commission")), shows_package(perf)),
        ("booked in the month", _booked(F.col("res_this_month"), F.col("gmv_this_month"))),
        ("against the month before", fmt.signed_percent(F.col("change_pct"), plus_at_zero=True)),
        ("neighbours' mean", fmt.one_decimal(F.col("region_avg_res")), shows_package(perf)),
        ("next tier", offer["name"]),
        ("which adds", offer["benefits"]),
    )
    prompt = F.concat_ws(
        "\n\n",
        F.concat(F.lit(f"Tell the host below, in the name of {rules.sender_team}, how the month went: "), month),
        known,
        F.when(advised, price_advice(F.col("host_price_per_res"), F.col("region_avg_price"))),
        fmt.lookup(perf, TONES, TONES["stable"]),
        F.lit(guidance),
    )
    return hosts.select("acm_id", "advert_name", prompt.alias("prompt"))


def upsell_summary_prompt(listed: DataFrame, guidance: str = TARGETS_GUIDANCE) -> DataFrame:
    """One prompt with a line for each of the first targets of the list."""
    first = listed.orderBy("list_no", "pos").limit(SUMMARY_LINES)
    line = F.concat_ws(
        "; ",
        F.concat_ws(" ", "grade", "acm_name"),
        F.concat(F.lit("booked "), _booked(F.col("res_90d"), F.col("gmv_90d")), F.lit(", neighbours "), fmt.one_decimal(F.col("avg_res"))),
        F.concat(F.lit("offer "), _tier(F.col("rec_package"), F.col("rec_rate"))),
        F.concat_ws(", ", "host_name", "host_email", fmt.phone(F.col("host_phone"))),
    )
    entries = F.array_sort(F.collect_list(F.struct("list_no", "pos", line.alias("line"))))
    lines = F.array_join(F.transform(entries, lambda e: e["line"]), "\n")
    return first.agg(F.concat_ws("\n\n", F.lit("Write to the sales team about these hosts."), lines, F.lit(guidance)).alias("prompt"))


def report_summary_prompt(hosts: DataFrame, month: Column, guidance: str = MONTH_GUIDANCE) -> DataFrame:
    """One prompt with the spread of the performance classes."""
    known = facts(("month", month), ("growing", F.col("growth")), ("steady", F.col("stable")), ("weak or without bookings", F.col("poor")), ("all", F.col("total")))
    text = F.concat_ws("\n\n", F.lit("Write to the team how the advertised stays did."), known, F.lit(guidance))
    return perf_buckets(hosts).select(text.alias("prompt"))


def upgrade_offers(hosts: DataFrame, packages: Packages) -> DataFrame:
    """Growing hosts and the next package they are offered."""
    offer = upgrade_offer(F.col("perf"), F.col("advert_commission"), packages)
    return hosts.withColumn("offer", offer).filter("offer is not null").withColumns(
        {"offer_package": F.col("offer.name"), "offer_benefits": F.col("offer.benefits")}
    ).drop("offer")
