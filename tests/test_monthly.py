from datetime import datetime
from decimal import Decimal

import pytest
from conftest import AS_OF, World, by_id, days_ago, ids

from staylift.operators import adverts, scoring
from staylift.operators.filters import month_range
from staylift.plans import monthly

MAY, MAY_END, APRIL = datetime(2025, 5, 1), datetime(2025, 5, 31, 23, 59, 59), datetime(2025, 4, 30, 23, 59, 59)


def test_month_bounds_include_whole_days(spark, world, rules):
    a = world.acm()
    world.advert(a, "0.15")
    for when in (MAY, MAY_END, APRIL, datetime(2025, 6, 1), datetime(2025, 3, 31, 23, 59, 59), datetime(2025, 4, 1)):
        world.book(a, when=when)
    row = by_id(monthly.monthly_ad_hosts(world.tables(spark), AS_OF, rules))[a]
    assert (row.res_this_month, row.res_last_month) == (2, 2)


@pytest.mark.parametrize("as_of, first, last", [
    (datetime(2025, 1, 31), "2024-12-01", "2024-12-31"), (datetime(2024, 3, 1), "2024-02-01", "2024-02-29"),
])
def test_month_range_and_label(spark, as_of, first, last):
    lo, hi = month_range(as_of, 1)
    row = spark.range(1).select(lo.cast("string"), hi.cast("string"), monthly.report_month(as_of)).first()
    assert tuple(row) == (first, last, f"{first[:4]}년 {int(first[5:7])}월")


def test_month_price_ignores_negative_suggestions(spark, world, rules):
    a = world.acm()
    world.advert(a, "0.15")
    world.book(a, when=MAY, suggested="-5", total="40", total_set="0")
    assert by_id(monthly.monthly_ad_hosts(world.tables(spark), AS_OF, rules))[a].gmv_this_month == 40


def naive_fanout(world: World, acm: int) -> tuple[int, int]:
    """Join every booking of one month to every booking of the other on the room, as two left joins do."""
    this_sum = last_sum = 0
    for room, owner in world.rows["rooms"]:
        if owner != acm:
            continue
        booked = [r for r in world.rows["reservations"] if r[1] == room and r[2] in (7, 8)]
        this = [int(r[6]) for r in booked if r[4].month == 5] or [None]
        last = [int(r[6]) for r in booked if r[4].month == 4] or [None]
        for x in this:
            for y in last:
                this_sum += x or 0
                last_sum += y or 0
    return this_sum, last_sum


def test_fanout_compat_equals_the_raw_joins(spark, world, rules):
    a = world.acm()
    world.advert(a, "0.20")
    for room, may, april in ((a * 1000, 3, 2), (world.room(a), 0, 4), (world.room(a), 2, 0), (world.room(a), 1, 1)):
        for i in range(may):
            world.book(a, when=MAY, total=str(10 + i), room=room)
        for i in range(april):
            world.book(a, when=APRIL, total=str(100 + i), room=room)
    t = world.tables(spark)
    plain = by_id(monthly.monthly_ad_hosts(t, AS_OF, rules))[a]
    raw = by_id(monthly.monthly_ad_hosts(t, AS_OF, rules, fanout_compat=True))[a]
    assert (raw.gmv_this_month, raw.gmv_last_month) == naive_fanout(world, a)
    assert (raw.res_this_month, raw.res_last_month) == (plain.res_this_month, plain.res_last_month) == (6, 7)
    assert raw.gmv_this_month >= plain.gmv_this_month


def test_latest_advert_ties(spark, world, rules):
    a = world.acm(phone=["1", "1"])
    for name, rate in (("x", "0.15"), ("y", "0.20"), ("y", "0.20")):
        world.advert(a, rate, name=name, started=days_ago(3))
    world.advert(a, "0.30", name="older", started=days_ago(4))
    world.advert(a, "0.10", name="newer but cheap", started=days_ago(1))
    world.book(a, when=MAY)
    t = world.tables(spark)
    qualifying = adverts.commission_at_least(adverts.active_adverts(t.accommodation_adverts, AS_OF), "0.15")
    rows = sorted((r.advert_name, r.copies) for r in adverts.latest_advert(qualifying).collect())
    assert rows == [("x", 1), ("y", 2)]
    plain = {r.advert_name: r.gmv_this_month for r in monthly.monthly_ad_hosts(t, AS_OF, rules).collect()}
    raw = {r.advert_name: (r.res_this_month, r.gmv_this_month) for r in monthly.monthly_ad_hosts(t, AS_OF, rules, compat=True).collect()}
    assert plain == {"x": 100, "y": 100} and raw == {"x": (1, 200), "y": (1, 400)}


@pytest.mark.parametrize("this, last, perf, change", [
    (0, 0, "zero", 0.0), (0, 5, "zero", -100.0), (3, 0, "new", 0.0), (12, 10, "growth", 20.0), (6, 5, "growth", 20.0),
    (119, 100, "stable", 19.0), (8, 10, "poor", -20.0), (81, 100, "stable", -19.0), (10, 10, "stable", 0.0), (4, 3, "growth", 33.3),
])
def test_classes(spark, this, last, perf, change):
    df = spark.createDataFrame([(this, last)], "t LONG, l LONG")
    from pyspark.sql import functions as F

    row = df.select(scoring.classify(F.col("t"), F.col("l")).alias("p"), F.round(scoring.change_pct(F.col("t"), F.col("l")), 1).alias("c")).first()
    assert (row.p, row.c) == (perf, change)


def test_scored_hosts_prices_advice_and_offers(spark, world, rules):
    from pyspark.sql import functions as F

    from staylift.operators import prompts

    cheap, dear, zero, growing, no_region = (world.acm(f"[제주/x] {i}", phone=None) for i in range(4)), None, None, None, None
    cheap, dear, zero, growing = cheap
    no_region = world.acm("[외딴 곳")
    for a, rate in ((cheap, "0.20"), (dear, "0.15"), (zero, "0.15"), (growing, "0.20"), (no_region, "0.30")):
        world.advert(a, rate)
    world.book(cheap, 2, when=MAY, total="100")
    world.book(dear, 1, when=MAY, total="1000")
    world.book(dear, 5, when=APRIL, total="10")
    world.book(growing, 3, when=MAY, total="100")
    world.book(growing, 1, when=APRIL)
    hosts = monthly.monthly_hosts(world.tables(spark), AS_OF, rules)
    rows = by_id(hosts)
    assert {a: rows[a].perf for a in (cheap, dear, zero, growing)} == {cheap: "new", dear: "poor", zero: "zero", growing: "growth"}
    assert rows[dear].price_high and not rows[cheap].price_high and rows[dear].host_price_per_res == 1000
    assert rows[dear].region_avg_price == int((100 + 1000 + 100) / 3) and rows[dear].region_avg_res == 1.5
    assert rows[zero].consecutive_zero and not rows[dear].consecutive_zero
    assert ids(scoring.needs_direct_call(hosts)) == sorted([zero, no_region])
    offers = by_id(prompts.upgrade_offers(hosts, rules.packages))
    assert set(offers) == {growing} and offers[growing].offer_package == rules.packages.top
    texts = {r.acm_id: r.prompt for r in monthly.monthly_prompts(hosts, AS_OF, rules).collect()}
    assert "own price per booking: 1,000 won" in texts[dear] and f"next tier: {rules.packages.top}" in texts[growing]
    assert "\ntier: " not in texts[zero] and "neighbours' mean" not in texts[zero] and "2025년 5월" in texts[zero]
    assert hosts.filter(F.col("pos") == 1).first().acm_id == growing


def test_report_and_mailing(spark, world, rules):
    for i in range(25):
        a = world.acm(f"[제주/x] {i}", email=f"h{i}@example.com")
        world.advert(a, "0.15")
        world.book(a, i, when=MAY)
    hosts = monthly.monthly_hosts(world.tables(spark), AS_OF, rules)
    copies = hosts.selectExpr("acm_id", "'s' AS subject", "'b' AS body").filter("acm_id % 2 = 0")
    out = monthly.monthly_report(hosts, copies, AS_OF).collect()
    kinds = {k: sum(r.kind == k for r in out) for k in ("card", "review", "header", "summary", "direct_call")}
    assert kinds["card"] == 20 and kinds["review"] == copies.count() and kinds["direct_call"] == 1
    texts = {r.kind: r.body for r in out}
    assert texts["header"].endswith("all: 25") and texts["footer"] == "5 more in the previews"
    assert texts["direct_call_heading"] == "To call: 1" and texts["title"].endswith(f"{AS_OF:%Y-%m-%d}")
    assert len(next(r.body for r in out if r.kind == "bulk").split(",")) == copies.count()
    log = spark.createDataFrame([("h24@example.com", days_ago(25)), ("h23@example.com", days_ago(25.001))], "email STRING, last_sent TIMESTAMP_NTZ")
    everyone = hosts.selectExpr("acm_id", "'s' AS subject", "'b' AS body")
    mails = monthly.monthly_mailing(hosts, everyone, log, "{{host_name}}{{#if_show_pkg}} {{pkg_name}}{{/if_show_pkg}}", hosts.select("acm_id"), AS_OF)
    outcome = {r.host_email: r.outcome for r in mails.collect()}
    assert outcome["h24@example.com"] == "skip" and outcome["h23@example.com"] == "success" and len(outcome) == 25
    html = {r.host_email: r.html for r in mails.collect()}
    assert html["h0@example.com"] == "호스트" and html["h1@example.com"] == "호스트 스타터 패키지" and html["h24@example.com"] is None


def test_tied_adverts_mail_once_unless_compat(spark, world, rules):
    a = world.acm()
    world.advert(a, "0.15", name="x", started=days_ago(3))
    world.advert(a, "0.20", name="y", started=days_ago(3))
    hosts = monthly.monthly_hosts(world.tables(spark), AS_OF, rules)
    copies = hosts.selectExpr("acm_id", "'s' AS subject", "'b' AS body").distinct()
    log = spark.createDataFrame([], "email STRING, last_sent TIMESTAMP_NTZ")
    counts = [monthly.monthly_mailing(hosts, copies, log, "", hosts.select("acm_id"), AS_OF, compat=c).count() for c in (False, True)]
    assert counts == [1, 2]
    assert Decimal(str(hosts.filter("advert_name = 'x'").first().advert_commission)) == Decimal("0.15")
