from datetime import timedelta
from decimal import Decimal

from conftest import AS_OF, by_id, days_ago, ids

from staylift import Rules
from staylift.operators import adverts, scoring
from staylift.operators.bookings import weekly_activity
from staylift.operators.copy import parse_copy
from staylift.plans import weekly


def no_ad(spark, world, rules, **options):
    return weekly.no_ad_targets(world.tables(spark), AS_OF, rules, **options)


def test_no_ad_keeps_only_eligible_accommodations(spark, world, rules):
    good = world.acm()
    rejected = [
        world.acm(email=None), world.acm(email="a@HOUSE.example"), world.acm(email="my.TEST@example.com"),
        world.acm(name="[부산/호텔] 워케이션 룸"), world.acm(type_name="직영 위탁"), world.acm(deleted=days_ago(1)), world.acm(test=True),
    ]
    kept = [world.acm(name="[부산/호텔] 룸"), world.acm(type_name="위탁 호텔"), good]
    for a in [*rejected, *kept]:
        world.book(a)
    unbooked, advertised = world.acm(), world.acm()
    world.book(advertised)
    world.advert(advertised, "0.10")
    assert ids(no_ad(spark, world, rules)) == sorted(kept)
    assert unbooked not in ids(no_ad(spark, world, rules))


def test_advert_must_be_paid_started_and_unexpired(spark, world, rules):
    cases = {
        "unpaid": dict(paid=False), "expired": dict(expires=days_ago(1)), "ends now": dict(expires=AS_OF),
        "future": dict(started=AS_OF + timedelta(days=1)),
    }
    without = []
    for advert in cases.values():
        a = world.acm()
        world.book(a)
        world.advert(a, "0.15", **advert)
        without.append(a)
    for advert in (dict(), dict(expires=AS_OF + timedelta(seconds=1)), dict(started=AS_OF)):
        a = world.acm()
        world.book(a)
        world.advert(a, "0.15", **advert)
    assert ids(no_ad(spark, world, rules)) == sorted(without)


def test_counts_six_statuses_but_values_three(spark, world, rules):
    a = world.acm()
    for status in (1, 3, 6, 7, 8, 12, 2, 9):
        world.book(a, status=status, total="10.5")
    row = by_id(no_ad(spark, world, rules))[a]
    assert (row.res_90d, row.gmv_90d) == (6, 33)


def test_window_is_on_creation_time_and_bounded_by_as_of(spark, world, rules):
    a = world.acm()
    world.book(a, when=days_ago(200), created=days_ago(90))
    world.book(a, when=days_ago(5), created=days_ago(90.001))
    world.book(a, when=days_ago(5), created=AS_OF + timedelta(seconds=1))
    world.book(a, when=days_ago(5), created=AS_OF)
    assert by_id(no_ad(spark, world, rules))[a].res_90d == 2


def test_upgrade_window_is_180_days_on_confirmation_and_zero_stays(spark, world, rules):
    a, idle = world.acm(), world.acm(email="test@example.com")
    for acm in (a, idle):
        world.advert(acm, "0.10")
    world.book(a, when=days_ago(180), created=days_ago(400))
    world.book(a, when=days_ago(180.001))
    world.book(a, status=12)
    found = by_id(weekly.upgrade_targets(world.tables(spark), AS_OF, rules))
    assert found[a].res_90d == 1 and found[idle].res_90d == 0 and found[idle].gmv_90d == 0
    stricter = weekly.upgrade_targets(world.tables(spark), AS_OF, rules, exclude_test=True)
    assert ids(stricter) == [a]


def test_price_choice(spark, world, rules):
    prices = {
        ("200.4", "1", "2"): 200, ("0", "99.5", "0"): 100, (None, "99.4", "0"): 99, (None, "1", "77.5"): 78,
        ("-5.5", "1", "2"): -6, (None, "1", None): 0,
    }
    expected = {}
    for (suggested, total, total_set), value in prices.items():
        a = world.acm()
        world.book(a, suggested=suggested, total=total, total_set=total_set)
        expected[a] = value
    found = by_id(no_ad(spark, world, rules))
    assert {a: found[a].gmv_90d for a in expected} == expected


def test_phones_default_and_compat(spark, world, rules):
    same, different = world.acm(phone=["0101", "0101"]), world.acm(phone=["0109", "0101"])
    for a in (same, different):
        world.book(a, 3)
    found = by_id(no_ad(spark, world, rules))
    assert [(found[a].host_phone, found[a].res_90d) for a in (same, different)] == [("0101", 3), ("0101", 3)]
    raw = sorted((r.acm_id, r.host_phone, r.res_90d, r.gmv_90d) for r in no_ad(spark, world, rules, compat=True).collect())
    assert raw == sorted([(same, "0101", 6, 600), (different, "0101", 3, 300), (different, "0109", 3, 300)])


def test_region_takes_last_bracket_before_first_slash(spark, world, rules):
    names = {"[제주/펜션] a": "제주", "x [[강릉/y/z]": "강릉", "no brackets": "no brackets", "[no slash] b": "no slash] b"}
    expected = {}
    for name, region in names.items():
        a = world.acm(name=name)
        world.book(a)
        expected[a] = region
    assert {a: r.region for a, r in by_id(no_ad(spark, world, rules)).items()} == expected


def test_limit_breaks_ties_by_id(spark, world, rules):
    tied = [world.acm() for _ in range(5)]
    for a in tied:
        world.book(a, 2)
    top = world.acm()
    world.book(top, 3)
    rows = [r.acm_id for r in no_ad(spark, world, rules, limit=3).collect()]
    assert rows == [top, *sorted(tied)[:2]]


def test_top_tier_ignores_higher_rates_and_keeps_ties(spark, world):
    a, tied = world.acm(), world.acm()
    world.advert(a, "0.10", name="low")
    world.advert(a, "0.30", name="high")
    for name in ("one", "two", "two"):
        world.advert(tied, "0.15", name=name)
    world.advert(tied, "0.10", name="lower")
    running = adverts.commission_at_most(adverts.active_adverts(world.tables(spark).accommodation_adverts, AS_OF), "0.15")
    rows = sorted((r.acm_id, r.advert_name, str(r.advert_commission)) for r in adverts.top_tier(running).collect())
    assert rows == sorted([(a, "low", "0.10"), (tied, "one", "0.15"), (tied, "two", "0.15")])


def test_grades_offers_and_extra_revenue(spark, rules):
    rows = [(n, 0 if n == 0 else n, 100000, None if rate is None else Decimal(rate)) for n, rate in
            [(0, None), (1, "0.10"), (2, "0.15"), (3, "0.20"), (9, "0.00"), (10, "0.30"), (11, "0.12"), (12, "0.10")]]
    targets = spark.createDataFrame(rows, "acm_id LONG, res_90d LONG, gmv_90d LONG, advert_commission DECIMAL(4,2)").selectExpr(
        "*", "'x' AS advert_name")
    scored = by_id(scoring.score_targets(targets, "upgrade", rules.packages))
    assert sorted(scored) == [0, 1, 2, 3, 12]
    assert [scored[i].grade for i in (0, 1, 2, 3, 12)] == ["D", "D", "C", "B", "A"]
    assert [scored[i].rec_rate for i in (0, 1, 2, 3)] == [0.15, 0.15, 0.2, 0.3]
    # The truncation of DOUBLE arithmetic is part of the contract.
    assert [scored[i].extra_rev_90d for i in (0, 1, 2, 3)] == [
        int(100000 * 0.15), int(100000 * (0.15 - 0.10)), int(100000 * (0.20 - 0.15)), int(100000 * (0.30 - 0.20))
    ]
    assert scored[1].extra_rev_90d == 4999


def test_one_scan_activity_equals_three_scans(spark, world, rules):
    for i in range(6):
        a = world.acm()
        for d in (0, 30, 89, 90, 91, 150, 180, 181):
            world.book(a, status=[1, 7, 8, 12, 2, 3][(i + d) % 6], when=days_ago(d), created=days_ago(d + i))
        if i % 2:
            world.advert(a, "0.10")
    t = world.tables(spark)
    act = weekly_activity(t.reservations, t.rooms, AS_OF, rules)
    shared = weekly.no_ad_targets(t, AS_OF, rules, activity=act.selectExpr("acm_id", "booked AS res", "booked_gmv AS gmv"))
    assert shared.collect() == weekly.no_ad_targets(t, AS_OF, rules).collect()
    shared = weekly.upgrade_targets(t, AS_OF, rules, activity=act.selectExpr("acm_id", "confirmed AS res", "confirmed_gmv AS gmv"))
    assert shared.collect() == weekly.upgrade_targets(t, AS_OF, rules).collect()


def test_cooldown_before_or_after_the_limit(spark, world, rules):
    first, second = world.acm(), world.acm()
    world.book(first, 5)
    world.book(second, 4)
    t = world.tables(spark)
    log = spark.createDataFrame([(first, days_ago(1))], "acm_id LONG, last_shown TIMESTAMP_NTZ")
    after = weekly.weekly_targets(t, AS_OF, rules, no_ad_limit=1, shown_log=log)
    before = weekly.weekly_targets(t, AS_OF, rules, no_ad_limit=1, shown_log=log, limit_after_cooldown=True)
    assert ids(after) == [] and ids(before) == [second]


def test_report_order_candidates_and_cards(spark, world):
    rules = Rules()
    for i in range(40):
        a = world.acm(name=f"[제주/펜션] {i}")
        world.book(a, 1 + i % 12)
    for i in range(12):
        a = world.acm(name=f"[강릉/펜션] {i}")
        world.advert(a, "0.10")
        world.book(a, 20)
    targets = weekly.weekly_targets(world.tables(spark), AS_OF, rules)
    copies = targets.selectExpr("acm_id", "concat('s', acm_id) AS subject", "'b' AS body").distinct()
    out = weekly.weekly_report(targets, copies, AS_OF, rules).collect()
    cards = [r for r in out if r.kind == "card"]
    assert [sum(r.list_no == n for r in cards) for n in (1, 2)] == [15, 10]
    # The first thirty are all taken from the first list, so no second-list card has copy.
    assert len([r for r in out if r.kind == "review"]) == 30
    assert all(("subject: " in r.body) == (r.list_no == 1) for r in cards)
    grades = [r.grade for r in targets.filter("list_no = 1").orderBy("pos").collect()]
    assert grades == sorted(grades)
    assert len([r for r in out if r.kind == "summary"]) == 1
    assert next(r.body for r in out if r.kind == "header") == "no advert: 40\nhigher tier: 12\nall: 52"
    assert next(r.body for r in out if r.kind == "title").endswith(f"{AS_OF:%Y-%m-%d}")
    assert {r.list_no: r.body for r in out if r.kind == "section"} == {1: "Without an advert: 40, 15 on cards", 2: "Ready for a higher tier: 12, 10 on cards"}
    bulk = [int(i) for i in next(r.body for r in out if r.kind == "bulk").split(",")]
    wanted = targets.filter("grade IN ('A', 'B')").orderBy("list_no", "pos").collect()
    assert bulk == [r.acm_id for r in wanted]
    prompts = weekly.weekly_prompts(targets, rules)
    assert prompts.count() == 30

    def generator(frames):
        for f in frames:
            f["response"] = ['{"subject": "push %d", "body": "b"}' % i for i in f.acm_id]
            yield f[["acm_id", "response"]]

    made = parse_copy(prompts.mapInPandas(generator, "acm_id LONG, response STRING"))
    assert made.count() == 30 and all(r.subject == f"푸시 {r.acm_id}" for r in made.collect())
    shown = weekly.shown_contacts(targets, AS_OF)
    assert shown.count() == 30 and {r.last_shown for r in shown.collect()} == {AS_OF}


def test_mailing_outcomes_options_and_log(spark, world, rules):
    from staylift.operators.cooldown import mark_sent

    fresh, cooling, double = world.acm(email="f@example.com"), world.acm(email="c@example.com"), world.acm(email="f@example.com")
    for a in (fresh, cooling, double):
        world.book(a)
    tied = world.acm(email="t@example.com")
    for name in ("x", "y"):
        world.advert(tied, "0.10", name=name)
    targets = weekly.weekly_targets(world.tables(spark), AS_OF, rules)
    copies = targets.selectExpr("acm_id", "'s' AS subject", "'b' AS body").distinct()
    log = spark.createDataFrame([("c@example.com", days_ago(14))], "email STRING, last_sent TIMESTAMP_NTZ")
    approved = targets.select("acm_id").distinct()

    def mail(**options):
        return weekly.weekly_mailing(targets, copies, log, "{{acm_id}}", AS_OF, ids=approved, **options)

    mails = mail()
    assert {r.acm_id: r.outcome for r in mails.collect()} == {fresh: "success", cooling: "skip", double: "success", tied: "success"}
    assert mails.filter("outcome = 'skip'").first().next_available == f"{AS_OF:%Y-%m-%d}"
    assert mail(compat=True).count() == 5 and mail(one_per_host=True).count() == 3
    assert mail(dry_run=True).filter("outcome = 'success'").count() == 4
    assert sorted(r.email for r in mark_sent(mails, AS_OF).collect()) == ["f@example.com", "t@example.com"]
    tests = mail(test_to="me@example.com")
    assert {r.recipient for r in tests.collect()} == {"me@example.com"} and all(r.subject == "[테스트] s" for r in tests.collect())
    assert mark_sent(tests, AS_OF, "me@example.com").count() == 0
    assert mark_sent(tests, AS_OF, "me@example.com", mark_tests=True).count() == 1
    box = weekly.mailing_outbox(mails, AS_OF).collect()
    assert sorted(r.kind for r in box) == ["mail"] * 4 + ["notice", "notice_heading"]
    assert next(r.body for r in box if r.kind == "notice_heading") == "Not mailed yet: 1"
    a_grade = weekly.weekly_mailing(targets, copies, log, "", AS_OF, grades=("A",))
    assert a_grade.count() == 0


def test_every_approved_target_is_mailed_whatever_its_place(spark, world, rules):
    many = [world.acm(email=f"h{i}@example.com") for i in range(8)]
    for n, a in enumerate(many):
        world.book(a, 20 - n)
    t = world.tables(spark)
    log = spark.createDataFrame([], "email STRING, last_sent TIMESTAMP_NTZ")
    copies = spark.createDataFrame([(a, 1, f'{{"subject": "{a}", "body": "b"}}') for a in many], "acm_id LONG, made INT, response STRING")
    ids = spark.createDataFrame([(many[0],), (many[7],), (999_999,)], "acm_id LONG")

    def mailed(targets, wanted=ids, **options):
        return ids_of(weekly.weekly_mailing(targets, copies, log, "", AS_OF, ids=wanted, order="made", **options))

    def ids_of(df):
        return sorted(r.acm_id for r in df.collect())

    assert mailed(weekly.weekly_targets(t, AS_OF, rules, no_ad_limit=3)) == [many[0]]
    whole = weekly.weekly_targets(t, AS_OF, rules, no_ad_limit=None, upgrade_limit=None, ids=ids)
    assert mailed(whole, limited=False) == [many[0], many[7]]
    assert [r.pos for r in whole.orderBy("pos").collect()] == [1, 2]
    # An approval without an id asks for the first of the list, besides the named ones.
    assert mailed(weekly.weekly_targets(t, AS_OF, rules), spark.createDataFrame([(None,), (many[7],)], "acm_id LONG")) == sorted(many)


def test_uncapped_lists_have_the_same_positions(spark, world, rules):
    for i in range(30):
        world.book(world.acm(), 1 + i % 7)
    t = world.tables(spark)
    limited, whole = (weekly.weekly_targets(t, AS_OF, rules, no_ad_limit=n, upgrade_limit=n) for n in (100, None))
    assert sorted(limited.collect()) == sorted(whole.select(*limited.columns).collect())
    from staylift.operators import lists

    parts = lists.bulk_ids(whole, ["list_no", "pos"], limited=False, size=7).orderBy("part").collect()
    assert [r.id_count for r in parts] == [7, 7, 7, 7, 2]
    assert [int(i) for r in parts for i in r.acm_ids.split(",")] == [r.acm_id for r in whole.orderBy("pos").collect()]


def test_delivery_reports_make_failures(spark, world, rules):
    from staylift.operators.cooldown import batch_outcome, mark_sent, with_deliveries

    rows = [(1, "a", "success"), (2, "b", "success"), (3, "c", "success"), (4, "d", "skip"), (5, None, "skip")]
    mailed = spark.createDataFrame(rows, "acm_id LONG, recipient STRING, outcome STRING")
    reports = spark.createDataFrame([(1, "a", False), (1, "a", True), (2, "b", False), (4, "d", False)], "acm_id LONG, recipient STRING, delivered BOOLEAN")
    done = with_deliveries(mailed, reports)
    assert {r.outcome: r.mails for r in batch_outcome(done).collect()} == {"success": 2, "fail": 1, "skip": 2}
    assert sorted(r.email for r in mark_sent(done, AS_OF).collect()) == ["a", "c"]
