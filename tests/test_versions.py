from __future__ import annotations

from datetime import timedelta
from decimal import Decimal

from conftest import AS_OF, days_ago
from pyspark.sql import functions as F

from staylift.operators import bookings, versions
from staylift.plans import monthly, weekly


def rows(df) -> list:
    return sorted(df.select(*sorted(df.columns)).collect(), key=str)


def landed_twice(world) -> None:
    """Every third booking and advert lands again as it is, every fourth has an outdated version, one has 300 copies."""
    for table, stamp in (("reservations", 4), ("accommodation_adverts", 4)):
        found = list(world.rows[table])
        for k, row in enumerate(found):
            if k % 3 == 0:
                world.rows[table].append(row)
            if k % 4 == 0 and row[stamp] is not None:
                earlier = list(row)
                earlier[stamp] = row[stamp] - timedelta(days=3)
                world.rows[table].append(tuple(earlier))
        world.rows[table] += [found[0]] * 300


def test_jobs_over_repeated_rows(spark, world, rules):
    for k in range(4):
        acm = world.acm(name=f"[제주/펜션] {k}")
        for j in range(6):
            world.book(acm, status=(7, 8, 3)[j % 3], when=days_ago(2 + 17 * j), total=str(100 + j))
        if k % 2:
            world.advert(acm, "0.15", started=days_ago(40))
            world.advert(acm, "0.15", started=days_ago(20), expires=AS_OF + timedelta(days=5))
    clean = world.tables(spark)
    landed_twice(world)
    t = world.tables(spark)
    assert rows(bookings.weekly_activity(t.reservations, t.rooms, AS_OF, rules)) != rows(bookings.weekly_activity(clean.reservations, clean.rooms, AS_OF, rules))
    whole = versions.with_unique_ids(t)
    assert rows(whole.reservations) == rows(clean.reservations)
    assert rows(whole.accommodation_adverts) == rows(clean.accommodation_adverts)
    for job in (weekly.no_ad_targets, weekly.upgrade_targets, monthly.monthly_ad_hosts):
        assert rows(job(whole, AS_OF, rules)) == rows(job(clean, AS_OF, rules))


def test_repeated_keys_are_counted(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "d")], "id LONG, x STRING")
    assert rows(versions.repeated(df)) == [(3, 1)]


def test_last_version_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, None, "z"), (1, 5, "a"), (1, 5, "b"), (2, None, None), (2, None, "x"), (3, 1, "only"), (None, 1, "free"), (None, 1, "free")],
        "id LONG, at INT, x STRING",
    ).withColumn("copies", F.lit(Decimal("1.5")))
    got = versions.last_versions(df, "id", ["at"])
    assert got.columns == df.columns
    assert sorted((r.id, r.at, r.x) for r in got.filter("id IS NOT NULL").collect()) == [(1, 5, "b"), (2, None, "x"), (3, 1, "only")]
    assert got.filter("id IS NULL").count() == 2
    assert versions.last_versions(df.limit(0), "id", ["at"]).count() == 0


def test_single_keys_are_not_shuffled(spark):
    df = spark.range(1000).selectExpr("id", "id AS at").union(spark.range(5).selectExpr("id", "id + 7 AS at"))
    got = versions.last_versions(df, "id", ["at"])
    assert got.count() == 1000 and got.filter("at = id + 7").count() == 5
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [id") == 1 and plan.startswith("Union")
