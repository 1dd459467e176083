"""Shapes of the physical plans that matter at scale."""

import re

import pytest
from conftest import AS_OF, World, days_ago

from checks import bindings as b
from staylift import Rules
from staylift.operators import adverts, bookings
from staylift.plans import monthly, weekly

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture
def no_broadcast(spark):
    """As if every table were too large to send around."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def jobs(spark):
    u, m = b.upsell_tables(spark, SF), b.monthly_tables(spark, SF)
    regions = u.accommodations.selectExpr("substring_index(name_expression, '/', 1) AS region").distinct()
    return {
        "no_ad": lambda: weekly.no_ad_targets(u, b.AS_OF, b.RULES),
        "upgrade": lambda: weekly.upgrade_targets(u, b.AS_OF, b.RULES),
        "hosts": lambda: monthly.monthly_ad_hosts(m, b.AS_OF, b.RULES),
        "baseline": lambda: weekly.region_ad_baseline(u, b.AS_OF, regions, b.RULES),
    }


@pytest.mark.parametrize("job", ["no_ad", "upgrade", "hosts", "baseline"])
def test_no_nested_loops_even_without_broadcasts(jobs, no_broadcast, job):
    text = plan(jobs[job]())
    assert "Cartesian" not in text and "NestedLoop" not in text and "Python" not in text


def test_no_ad_plan(jobs):
    text = plan(jobs["no_ad"]())
    assert "LeftAnti" in text and "TakeOrderedAndProject" in text
    scan = re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(l_shipdate,1997-10-17T00:00\).*\]\nReadSchema: (.*)", text)
    assert scan and "l_tax" not in scan.group(1) and "l_quantity" not in scan.group(1)


def test_users_and_phones_come_after_what_thins_the_list(jobs, no_broadcast):
    """Bookings and adverts, keyed by accommodation, are joined below the users, and phones only meet the limited list."""
    text = plan(jobs["no_ad"]()).split("\n\n")[0]
    # Of these, one join and four exchanges are the binding's own (accommodations made of two tables, types of their rows).
    assert (text.count("SortMergeJoin"), text.count("Exchange")) == (7, 14)
    top = text.index("TakeOrderedAndProject")
    limit = text.index("TakeOrderedAndProject", top + 1)
    assert "SortMergeJoin LeftOuter" in text[top:limit] and "SortMergeJoin LeftAnti" in text[limit:]


def test_month_filter_is_pushed_down(jobs):
    text = plan(jobs["hosts"]())
    assert "GreaterThanOrEqual(l_shipdate,1997-11-01T00:00), LessThan(l_shipdate,1998-01-01T00:00)" in text


def test_bookings_combine_before_they_move(spark, no_broadcast):
    t = b.upsell_tables(spark, SF)
    text = plan(bookings.booked_in_window(t.reservations, t.rooms, b.AS_OF, b.RULES)).split("\n\n")[0]
    # Per room: partial sums, exchange, sums; the join reuses that exchange; per accommodation likewise.
    assert text.count("Exchange") == 3 and text.count("HashAggregate") == 4


@pytest.mark.parametrize("pick", [adverts.top_tier, adverts.latest_advert])
def test_best_advert_is_limited_map_side(spark, pick):
    world = World()
    world.advert(world.acm(), "0.10")
    text = plan(pick(world.tables(spark).accommodation_adverts))
    first, second = [m.start() for m in re.finditer("WindowGroupLimit", text.split("\n\n")[0])]
    assert "Exchange" in text[first:second]


def test_hot_user_and_hot_room_are_right(spark):
    """One user owns and one room holds a third of everything; sums are exact."""
    world, rules = World(), Rules()
    owned = [world.acm() for _ in range(30)]
    owner = world.rows["users"][0][0]
    world.rows["accommodations"] = [
        (*r[:3], owner if i < 10 else r[3], *r[4:]) for i, r in enumerate(world.rows["accommodations"])
    ]
    world.book(owned[0], 300, when=days_ago(1))
    for a in owned[1:]:
        world.book(a, 20)
    found = {r.acm_id: r.res_90d for r in weekly.no_ad_targets(world.tables(spark), AS_OF, rules).collect()}
    assert found == {owned[0]: 300, **{a: 20 for a in owned[1:]}}
