import re

import pytest
from conftest import AS_OF, World
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from staylift import Rules
from staylift.operators.baselines import match_regions
from staylift.plans import monthly, weekly

NAMES = ["[강릉/펜션] 바다", "[강릉시/호텔] a", "[A_B/x] y", "[AxB/x] 강릉", "a%b/c", "", "aXXb/c", "100%", "_", "back\\slash"]


def like(name: str, region: str) -> bool:
    parts = [".*" if c == "%" else "." if c == "_" else re.escape(c) for c in region]
    return re.search("(?s)" + "".join(parts), name) is not None


def pairs(spark, names, regions, **options):
    named = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "acm_id LONG, acm_name STRING")
    wanted = spark.createDataFrame([(r,) for r in regions], "region STRING")
    return sorted((r.acm_id, r.region) for r in match_regions(named, wanted, **options).collect())


def brute(names, regions):
    return sorted((i, r) for i, n in enumerate(names) for r in set(regions) if like(n, r))


def test_contains_match_with_wildcards(spark):
    regions = ["강릉", "강릉시", "A_B", "a%b", "%", "__", "a%%b", "nowhere", "%강릉", "b_c", "back\\slash", "강릉"]
    assert pairs(spark, NAMES, regions) == brute(NAMES, regions)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.text("ab_%/", max_size=8), min_size=1, max_size=8),
    st.lists(st.text("ab_%", min_size=1, max_size=4), min_size=1, max_size=5),
)
def test_contains_match_equals_brute_force(spark, names, regions):
    assert pairs(spark, names, regions) == brute(names, regions)


def test_stretches_are_dropped_before_they_are_exploded(spark):
    """Rows that the lookup of pieces is given, with and without regions that the names hold."""
    names = [f"[region {n % 50}/kind] a rather long name of place {n}" for n in range(400)]
    named = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "acm_id LONG, acm_name STRING")
    regions = [f"region {n}/" for n in range(50)] + ["nowhere at all"]
    matched = match_regions(named, spark.createDataFrame([(r,) for r in regions], "region STRING"))
    assert matched.count() == 400
    matched.collect()
    plan = matched._jdf.queryExecution().executedPlan()
    made = generated_rows(plan)
    assert made and max(made) <= 400 * 1.1


def generated_rows(plan):
    """Output rows of all Generate nodes of an executed plan."""
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    name, children = plan.nodeName(), plan.children()
    if plan.getClass().getSimpleName().endswith("QueryStageExec"):
        return generated_rows(plan.plan())
    own = [plan.metrics().apply("numOutputRows").value()] if name == "Generate" else []
    return own + [n for k in range(children.size()) for n in generated_rows(children.apply(k))]


def test_exact_match_and_bad_option(spark):
    assert pairs(spark, NAMES, ["강릉", "강릉시"], match="exact") == [(0, "강릉"), (1, "강릉시")]
    with pytest.raises(ValueError):
        pairs(spark, NAMES, ["강릉"], match="fuzzy")


def test_baseline_counts_idle_adverts_and_unknown_regions(spark):
    world, rules = World(), Rules()
    busy, idle, prefix = world.acm("[강릉/a] 1"), world.acm("[강릉/a] 2"), world.acm("[강릉시/a] 3", email="test@house.example")
    for a in (busy, idle, prefix):
        world.advert(a, "0.30")
    world.book(busy, 3)
    world.book(prefix, 1, total="70")
    no_ad = world.acm("[강릉/a] 4")
    world.book(no_ad, 9)
    t = world.tables(spark)
    regions = spark.createDataFrame([("강릉",), ("제주",)], "region STRING")
    rows = {r.region: (r.avg_res, r.ad_acm_cnt) for r in weekly.region_ad_baseline(t, AS_OF, regions, rules).collect()}
    assert rows == {"강릉": (pytest.approx(4 / 3), 3), "제주": (0.0, 0)}
    exact = {r.region: r.ad_acm_cnt for r in weekly.region_ad_baseline(t, AS_OF, regions, rules, match="exact").collect()}
    assert exact == {"강릉": 2, "제주": 0}
    assert {r.region: r.ad_acm_cnt for r in monthly.region_month_baseline(t, AS_OF, regions, rules).collect()} == {"강릉": 3, "제주": 0}
