"""Texts of the review report: titles, headings, cards, previews, notices."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylift.functions import formats as fmt
from staylift.functions.text import facts, strip
from staylift.operators.lists import MONTHLY_CARDS, NO_AD_CARDS, UPGRADE_CARDS, perf_buckets

UPSELL_TITLE, REPORT_TITLE = "Hosts to write to", "Advertised stays"
LISTS = {1: "Without an advert", 2: "Ready for a higher tier"}


def _tier(name: str, rate: str) -> Column:
    return F.format_string("%s, %d%%", F.coalesce(F.col(name), F.lit("")), fmt.rate_percent(F.col(rate)))


def _reach() -> Column:
    return F.concat_ws(" / ", F.col("host_email"), fmt.phone(F.col("host_phone")))


def upsell_card_text() -> Column:
    """Over scored targets with region figures and optional copy; lines that do not apply are left out."""
    first, body = F.col("list_no") == 1, strip(F.col("body"))
    head = F.concat_ws(" ", fmt.lookup(F.col("grade"), fmt.GRADE_SYMBOLS, ""), "grade", "acm_name")
    return F.concat_ws(
        "\n",
        head,
        facts(
            ("tier", _tier("advert_name", "advert_commission"), ~first),
            ("booked", F.col("res_90d")),
            ("neighbours", fmt.one_decimal(F.col("avg_res")), first),
            ("value", fmt.thousands(F.col("gmv_90d"))),
            ("offer", _tier("rec_package", "rec_rate")),
            ("may add", fmt.thousands(F.col("extra_rev_90d"))),
            ("reach", _reach()),
            ("subject", F.col("subject"), F.col("has_copy")),
        ),
        F.when(F.col("has_copy") & (body != ""), body),
    )


def carded(targets: DataFrame) -> DataFrame:
    """The first of each list get a card."""
    cap = F.when(F.col("list_no") == 1, NO_AD_CARDS).otherwise(UPGRADE_CARDS)
    return targets.filter(F.col("pos") <= cap)


def upsell_cards(targets: DataFrame) -> DataFrame:
    return carded(targets).select("list_no", "pos", "acm_id", "has_copy", upsell_card_text().alias("card"))


def report_card_text() -> Column:
    prices = F.concat_ws(" over ", fmt.thousands(F.col("host_price_per_res")), fmt.thousands(F.col("region_avg_price")))
    return F.concat_ws(
        "\n",
        F.concat_ws(" ", fmt.lookup(F.col("perf"), fmt.PERF_SYMBOLS, "⚪"), "acm_name"),
        facts(
            ("tier", _tier("advert_name", "advert_commission")),
            ("booked", F.col("res_this_month")),
            ("change", fmt.signed_percent(F.col("change_pct"), plus_at_zero=False)),
            ("value", fmt.thousands(F.col("gmv_this_month"))),
            ("price", prices, F.col("price_high")),
            ("reach", _reach()),
            ("subject", F.col("subject"), F.col("has_copy")),
        ),
    )


def report_cards(hosts: DataFrame) -> DataFrame:
    """``hosts`` carry their position ``pos`` in the report."""
    return hosts.filter(F.col("pos") <= MONTHLY_CARDS).select("pos", "acm_id", "has_copy", report_card_text().alias("card"))


def title(text: str, as_of: datetime) -> Column:
    return F.lit(f"{text}, {as_of:%Y-%m-%d}")


def upsell_header(targets: DataFrame) -> DataFrame:
    """One row: how many targets each list has."""
    counts = targets.agg(F.count_if(F.col("list_no") == 1).alias("no_ad"), F.count_if(F.col("list_no") == 2).alias("upgrade"))
    return counts.select(facts(("no advert", F.col("no_ad")), ("higher tier", F.col("upgrade")), ("all", F.col("no_ad") + F.col("upgrade"))).alias("header"))


def upsell_headings(targets: DataFrame) -> DataFrame:
    """list_no, heading: one row per list that has targets, with how many of them stand below it as cards."""
    cap = F.when(F.col("list_no") == 1, NO_AD_CARDS).otherwise(UPGRADE_CARDS)
    counts = targets.groupBy("list_no").agg(F.count(F.lit(1)).alias("n"))
    name = F.when(F.col("list_no") == 1, LISTS[1]).otherwise(LISTS[2])
    return counts.select("list_no", F.format_string("%s: %d, %d on cards", name, "n", F.least("n", cap)).alias("heading"))


def report_header(hosts: DataFrame) -> DataFrame:
    """One row: the class counts, and how many hosts have no card."""
    more = F.greatest(F.col("total") - MONTHLY_CARDS, F.lit(0))
    header = facts(("growing", F.col("growth")), ("steady", F.col("stable")), ("weak or none", F.col("poor")), ("all", F.col("total")))
    return perf_buckets(hosts).select(header.alias("header"), more.alias("not_carded"))


def report_footer(hosts: DataFrame) -> DataFrame:
    """One row where hosts are left without a card: where to find them."""
    return report_header(hosts).filter("not_carded > 0").select(F.format_string("%d more in the previews", "not_carded").alias("footer"))


def direct_call_heading(hosts: DataFrame) -> DataFrame:
    """One row where any host had no booking in both months: how many to call."""
    calls = hosts.filter("consecutive_zero").agg(F.count(F.lit(1)).alias("n")).filter("n > 0")
    return calls.select(F.format_string("To call: %d", "n").alias("heading"))


def direct_call_line() -> Column:
    return F.concat_ws(" / ", "acm_name", _reach(), _tier("advert_name", "advert_commission"))


def review_text(label: str) -> Column:
    return F.concat_ws("\n\n", facts((label, F.col("acm_name")), ("to", F.col("host_email")), ("subject", F.col("subject"))), F.col("body"))


def review_texts(targets: DataFrame, label: str = "offer") -> DataFrame:
    """The whole mail of every target that has copy, for the reviewer."""
    return targets.filter("has_copy").select("acm_id", review_text(label).alias("review"))


def blocked_heading(blocked: DataFrame) -> DataFrame:
    """One row with the number of blocked targets of a mailing; none if there are none."""
    return blocked.agg(F.count(F.lit(1)).alias("n")).filter("n > 0").select(F.format_string("Not mailed yet: %d", "n").alias("heading"))


def blocked_notices(blocked: DataFrame) -> DataFrame:
    """A line for each blocked target: list_no, pos, acm_id, notice."""
    line = F.concat_ws(" / ", "acm_name", "host_email", F.concat(F.lit("from "), F.col("next_available")))
    return blocked.select("list_no", "pos", "acm_id", line.alias("notice"))
