from __future__ import annotations

import random
from datetime import timedelta

from conftest import AS_OF, World, days_ago
from pyspark.sql import functions as F

from staylift.operators import adverts as a
from staylift.operators import advert_timeline as line
from staylift.plans import monthly, weekly
from staylift.sources.workspace import settle

EVERY = [days_ago(k) for k in range(-3, 42, 4)]


def rows(df) -> list:
    return sorted(df.select(*sorted(df.columns)).collect(), key=str)


def many(world: World, per: tuple[int, ...] = (1, 3, 12, 90)) -> list[int]:
    """Adverts that overlap, follow one another, tie, repeat, never start, never end, or end before they start."""
    rng, acms = random.Random(3), []
    for k, n in enumerate(per):
        acm = world.acm(name=f"[제주/펜션] {k}")
        acms.append(acm)
        for _ in range(n):
            start = days_ago(rng.randrange(0, 40))
            ends = rng.choice([None, start + timedelta(days=rng.randrange(1, 15)), start, start - timedelta(days=1)])
            for _ in range(rng.choice([1, 1, 2])):
                world.advert(acm, rng.choice(["0.10", "0.15", "0.20"]), name=rng.choice(["A", "B", None]), started=start, expires=ends, paid=rng.random() > 0.1)
    return acms


def test_spans_equal_the_running_adverts_of_every_date(spark, world):
    many(world)
    t = world.tables(spark).accommodation_adverts
    best, latest = settle(line.best_timeline(t)), settle(line.latest_timeline(t))
    moments = [*EVERY, *(m + timedelta(microseconds=us) for m in EVERY[2:5] for us in (-1, 1))]
    all_best, all_latest = line.replayed(best, moments).collect(), line.replayed(latest, moments).collect()
    for m in moments[:6] + moments[-3:]:
        active = a.active_adverts(t, m)
        assert rows(line.counting_on(best, m)) == rows(a.top_tier(active))
        assert rows(line.counting_on(latest, m)) == rows(a.latest_advert(active))
    for m in moments:
        active = a.active_adverts(t, m)
        assert len([r for r in all_best if r.as_of == m]) == a.top_tier(active).count()
        assert sum(r.copies for r in all_latest if r.as_of == m) == sum(r.copies for r in a.latest_advert(active).collect())


def test_spans_are_merged(spark, world):
    acm = world.acm()
    world.advert(acm, "0.15", started=days_ago(30), expires=days_ago(20))
    world.advert(acm, "0.15", started=days_ago(25), expires=days_ago(10))
    world.advert(acm, "0.10", started=days_ago(22), expires=days_ago(15))
    world.advert(acm, "0.20", started=days_ago(5))
    found = sorted((r.starts, r.ends, str(r.advert_commission)) for r in line.best_timeline(world.tables(spark).accommodation_adverts).collect())
    assert found == [(days_ago(30), days_ago(10), "0.15"), (days_ago(5), None, "0.20")]


def test_many_adverts_side_by_side_take_few_rows(spark, world):
    acm, n = world.acm(), 200
    for k in range(n):
        world.advert(acm, "0.15", name=str(k), started=days_ago(400 - k), expires=days_ago(100 - k % 50))
    spans = line.latest_timeline(world.tables(spark).accommodation_adverts)
    assert spans.count() <= 2 * n


def test_empty(spark, world):
    world.advert(world.acm(), "0.15", paid=False)
    t = world.tables(spark).accommodation_adverts
    assert line.best_timeline(t).count() == 0
    assert line.replayed(line.latest_timeline(t), EVERY).count() == 0


def test_jobs_take_the_lookup(spark, world, rules):
    for acm in many(world, (2, 5, 9)):
        world.book(acm, 3)
    t = world.tables(spark)
    low = line.best_timeline(a.commission_at_most(t.accommodation_adverts, rules.upgrade_max_rate))
    high = line.latest_timeline(a.commission_at_least(t.accommodation_adverts, rules.report_min_rate))
    for m in (AS_OF, days_ago(9)):
        got = weekly.upgrade_targets(t, m, rules, tiers=line.counting_on(low, m))
        assert rows(got) == rows(weekly.upgrade_targets(t, m, rules)) and got.count()
        assert rows(monthly.monthly_ad_hosts(t, m, rules, latest=line.counting_on(high, m))) == rows(monthly.monthly_ad_hosts(t, m, rules))


def test_no_row_of_pairs(spark, world):
    """An advert is stored at two nodes a level at most."""
    spans = spark.range(0, 64).select(F.col("id").alias("first")).join(spark.range(1, 65).select(F.col("id").alias("after")), F.col("first") < F.col("after"))
    cut = spans.select("first", "after", F.inline(line._tree_nodes("first", "after")))
    covered = cut.withColumn("no", F.explode(F.expr("sequence(shiftleft(node, level), shiftleft(node + 1, level) - 1)")))
    got = covered.groupBy("first", "after").agg(F.count("*").alias("n"), F.countDistinct("no").alias("d"), F.min("no").alias("low"), F.max("no").alias("high"))
    assert got.count() == spans.count()
    assert got.filter("n <> d OR n <> after - first OR low <> first OR high <> after - 1").count() == 0
    assert cut.groupBy("first", "after").count().agg(F.max("count")).first()[0] <= 12
