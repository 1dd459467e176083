from datetime import timedelta

from conftest import AS_OF, days_ago, ids
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from staylift.operators import cooldown
from staylift.sources.contact_log import merge_contacts

SENT = "email STRING, last_sent TIMESTAMP_NTZ"
SHOWN = "acm_id LONG, last_shown TIMESTAMP_NTZ"
TARGETS = "acm_id LONG, host_email STRING"


def test_shown_gate_opens_at_exactly_seven_days(spark):
    targets = spark.createDataFrame([(i,) for i in range(4)], "acm_id LONG")
    log = spark.createDataFrame([(0, days_ago(7)), (1, days_ago(7) + timedelta(microseconds=1)), (2, AS_OF + timedelta(days=1))], SHOWN)
    assert ids(cooldown.not_recently_shown(targets, log, AS_OF, 7)) == [0, 3]


def test_sent_gate_needs_more_than_fourteen_days(spark):
    rows = [(0, "a"), (1, "b"), (2, "c"), (3, None), (4, ""), (5, "a")]
    targets = spark.createDataFrame(rows, TARGETS)
    log = spark.createDataFrame([("a", days_ago(14)), ("a", days_ago(50)), ("b", days_ago(14) - timedelta(microseconds=1))], SENT)
    assert ids(cooldown.pending(targets, log, AS_OF, 14)) == [1, 2]
    stopped = {r.acm_id: r.next_available for r in cooldown.blocked(targets, log, AS_OF, 14).collect()}
    assert stopped == {0: "2025-06-16", 5: "2025-06-16", 3: "알 수 없음", 4: "알 수 없음"}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", "", None]), st.integers(0, 30)), max_size=8), st.sampled_from([14, 25]))
def test_pending_and_blocked_split_the_input(spark, contacts, days):
    targets = spark.createDataFrame(list(enumerate(["a", "b", "c", "d", "", None, "a"])), TARGETS)
    log = spark.createDataFrame([(e, days_ago(d)) for e, d in contacts if e], SENT)
    pending, blocked = ids(cooldown.pending(targets, log, AS_OF, days)), ids(cooldown.blocked(targets, log, AS_OF, days))
    assert sorted(pending + blocked) == list(range(7))
    judged = cooldown.with_outcome(targets, log, AS_OF, days)
    assert ids(judged.filter("outcome = 'skip'")) == blocked and ids(judged.filter("outcome = 'success'")) == pending
    newest = {e: min(d for x, d in contacts if x == e) for e, _ in contacts if e}
    assert pending == [i for i, e in enumerate(["a", "b", "c", "d", "", None, "a"]) if e and newest.get(e, 99) > days]


def test_merge_is_idempotent_and_order_free(spark):
    log = spark.createDataFrame([(1, days_ago(3)), (2, days_ago(9))], SHOWN)
    new = spark.createDataFrame([(2, days_ago(1)), (3, days_ago(2)), (1, days_ago(5))], SHOWN)
    merged = merge_contacts(log, new, "acm_id", "last_shown")
    expected = {1: days_ago(3), 2: days_ago(1), 3: days_ago(2)}
    for again in (merged, merge_contacts(merged, new, "acm_id", "last_shown"), merge_contacts(new, log, "acm_id", "last_shown")):
        assert {r.acm_id: r.last_shown for r in again.collect()} == expected
