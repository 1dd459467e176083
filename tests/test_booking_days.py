from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from conftest import AS_OF, World, days_ago
from pyspark.sql import functions as F

from staylift import Rules
from staylift.operators import bookings
from staylift.plans import booking_days as d
from staylift.plans import monthly, weekly
from staylift.sources.contact_log import batch_name
from staylift.sources.runs import read_published

TODAY = AS_OF.date()


def back(first: int, last: int) -> list[date]:
    return [TODAY - timedelta(days=k) for k in range(last, first + 1)]


def busy(world: World) -> list[int]:
    """Bookings of every status, at the edges of every window, with prices that are null, zero and negative."""
    acms = [world.acm(name=f"[제주/펜션] {k}") for k in range(4)]
    rooms = [world.room(acms[0]), world.room(acms[1])]
    edges = [days_ago(k) + timedelta(microseconds=us) for k in (0, 90, 180) for us in (-1, 0, 1)]
    months = [datetime(2025, m, 1) + timedelta(microseconds=us) for m in (4, 5, 6) for us in (-1, 0)]
    middle = [days_ago(0.3 + 1.7 * k) for k in range(110)]
    for k, when in enumerate([*edges, *months, *middle]):
        made = when - timedelta(days=k % 9, hours=k % 5)
        world.book(acms[k % 4], 1 + k % 2, status=(1, 3, 6, 7, 8, 12, 2)[k % 7], when=when, created=made if k % 3 else when,
                   suggested=(None, "0", "50", "-20")[k % 4], total_set=("0", "80", None)[k % 3], room=rooms[k % 2] if k % 4 == k % 2 else None)
    world.book(acms[3], status=7, when=days_ago(5), created=None)
    return acms


def rows(df) -> list:
    return sorted(df.select(*sorted(df.columns)).collect())


def same_as_scan(t, path, rules) -> None:
    assert rows(d.weekly_activity(t.reservations, t.rooms, path, AS_OF, rules)) == rows(bookings.weekly_activity(t.reservations, t.rooms, AS_OF, rules))
    for fanout in (False, True):
        got = d.monthly_activity(t.reservations, t.rooms, path, AS_OF, rules, fanout_compat=fanout)
        assert rows(got) == rows(bookings.monthly_activity(t.reservations, t.rooms, AS_OF, rules, fanout_compat=fanout))


@pytest.mark.parametrize("stated", [[], back(200, 0), back(200, 30), back(60, 20), back(200, 0)[::3]], ids=["none", "all", "old", "middle", "third"])
def test_windows_equal_the_scan(spark, world, rules, tmp_path, stated):
    busy(world)
    t, path = world.tables(spark), str(tmp_path / "days")
    if stated:
        assert d.state_days(t.reservations, path, batch_name(1), stated)
    same_as_scan(t, path, rules)


def test_other_spans_and_statuses(spark, world, tmp_path):
    busy(world)
    t, path = world.tables(spark), str(tmp_path / "days")
    d.state_days(t.reservations, path, batch_name(1), back(400, 3))
    same_as_scan(t, path, Rules(no_ad_days=1, upgrade_days=2, baseline_days=365, paid_statuses=(2,), confirmed_statuses=(3, 8)))
    same_as_scan(t, path, Rules(no_ad_days=0, upgrade_days=0, baseline_days=0))


def test_stated_days_are_not_read_again(spark, world, rules, tmp_path):
    busy(world)
    t, path = world.tables(spark), str(tmp_path / "days")
    d.state_days(t.reservations, path, batch_name(1), back(200, 1))
    expected = rows(bookings.weekly_activity(t.reservations, t.rooms, AS_OF, rules))
    # Of the bookings only the edges are left: the days in which the windows begin and end.
    edges = F.lit(False)
    for stamp in (d.CREATED, d.CONFIRMED):
        edges = edges | F.to_date(stamp).isin([TODAY, *(TODAY - timedelta(days=k) for k in (90, 180))])
    assert t.reservations.filter(edges).count() < t.reservations.count() / 4
    assert rows(d.weekly_activity(t.reservations.filter(edges), t.rooms, path, AS_OF, rules)) == expected
    # The last two months are stated as a whole, and nothing is left to read.
    assert rows(d.monthly_activity(t.reservations.limit(0), t.rooms, path, AS_OF, rules)) == rows(
        bookings.monthly_activity(t.reservations, t.rooms, AS_OF, rules)
    )


def test_late_bookings_state_their_days_again(spark, world, rules, tmp_path):
    busy(world)
    before = world.tables(spark).reservations
    path = str(tmp_path / "days")
    d.state_days(before, path, batch_name(9), back(200, 1))
    acm = world.rows["accommodations"][0][0]
    world.book(acm, 3, status=7, when=days_ago(40), created=days_ago(50), total="70")
    moved = world.rows["reservations"][20]
    world.rows["reservations"][20] = (*moved[:2], 8, moved[3], moved[4] - timedelta(days=11), *moved[5:])
    t = world.tables(spark)
    days = d.changed_days(t.reservations.exceptAll(before).unionByName(before.exceptAll(t.reservations)))
    assert len(days) <= 5
    assert rows(d.weekly_activity(t.reservations, t.rooms, path, AS_OF, rules)) != rows(bookings.weekly_activity(t.reservations, t.rooms, AS_OF, rules))
    # The tenth run sorts after the ninth.
    d.state_days(t.reservations, path, batch_name(10), days)
    same_as_scan(t, path, rules)
    assert read_published(spark, path, "sums", d.SUMS).filter(F.col("run") == batch_name(10)).select("day").distinct().count() <= len(days)


def test_a_day_that_lost_its_bookings(spark, world, rules, tmp_path):
    acm = world.acm()
    world.book(acm, 2, when=days_ago(10))
    t, path = world.tables(spark), str(tmp_path / "days")
    d.state_days(t.reservations, path, batch_name(1), back(200, 1))
    none = t.reservations.limit(0)
    d.state_days(none, path, batch_name(2), back(10, 10))
    assert d.weekly_activity(none, t.rooms, path, AS_OF, rules).collect() == []
    assert d.stated_days(spark, path, TODAY - timedelta(days=10), TODAY) == {
        day: batch_name(2 if day == TODAY - timedelta(days=10) else 1) for day in back(10, 1)
    }


def test_a_run_that_broke_off_shows_nothing(spark, world, rules, tmp_path):
    busy(world)
    t, path = world.tables(spark), str(tmp_path / "days")
    d.state_days(t.reservations, path, batch_name(1), back(200, 1))
    # Sums are written, the run is not published: half of a second run, over wrong bookings.
    d.daily_sums(t.reservations.limit(3), back(200, 1)).write.parquet(f"{path}/sums/run={batch_name(2)}")
    same_as_scan(t, path, rules)
    assert d.state_days(t.reservations, path, batch_name(2), back(200, 1))
    assert not d.state_days(t.reservations.limit(0), path, batch_name(2), back(200, 1))
    same_as_scan(t, path, rules)


def test_days_reach_the_scan(spark, world, tmp_path):
    busy(world)
    path = str(tmp_path / "reservations")
    world.tables(spark).reservations.write.parquet(path)
    plan = d.daily_sums(spark.read.parquet(path), [TODAY, TODAY - timedelta(days=1)])._jdf.queryExecution().toString()
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "created_at" in pushed.split("PushedFilters")[1] and "Or(" in pushed.split("PushedFilters")[1]
    assert d._ranges([TODAY, TODAY - timedelta(days=1)]) == [(datetime(2025, 6, 15), datetime(2025, 6, 17))]


def test_jobs_take_the_activity(spark, world, rules, tmp_path):
    for acm in busy(world):
        world.advert(acm, "0.15")
    free = world.acm(name="[제주/펜션] 무광고")
    world.book(free, 4)
    t, path = world.tables(spark), str(tmp_path / "days")
    d.state_days(t.reservations, path, batch_name(1), back(200, 1))
    kept = d.weekly_activity(t.reservations, t.rooms, path, AS_OF, rules)
    assert rows(weekly.weekly_targets(t, AS_OF, rules, activity=kept)) == rows(weekly.weekly_targets(t, AS_OF, rules))
    kept = d.monthly_activity(t.reservations, t.rooms, path, AS_OF, rules)
    assert rows(monthly.monthly_hosts(t, AS_OF, rules, activity=kept)) == rows(monthly.monthly_hosts(t, AS_OF, rules))


def test_many_ranges_are_a_hull_and_a_set(spark):
    day = datetime(2025, 3, 1)
    edges = [(day - timedelta(hours=5), day), *d._ranges([day.date() + timedelta(days=k) for k in (0, 3, 4, 9, 40, 41, 50, 90)])]
    ranges = [(edges[0][0], edges[1][1]), *edges[2:], (day + timedelta(days=120, hours=1), day + timedelta(days=120, hours=2))]
    assert len(ranges) > d.FEW
    hull = d._hull(ranges)
    assert len(hull) <= d.FEW and all(any(a <= x and y <= b for a, b in hull) for x, y in ranges)
    moments = [m + timedelta(microseconds=us) for r in ranges for m in r for us in (-1, 0, 1)] + [day + timedelta(hours=7 * k) for k in range(-9, 500)]
    df = spark.createDataFrame([(m,) for m in moments], "at TIMESTAMP_NTZ").withColumn("got", d._inside("at", ranges))
    for r in df.collect():
        assert r.got == any(a <= r.at < b for a, b in ranges), r
