"""The registered queries: a Spark callable and, where SQL can say it, the statement that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import bindings as b
from checks import oracles as o
from checks.bindings import AS_OF, CONTACTS_AS_OF, RULES
from checks.oracles import compose
from staylift.functions import formats as fmt
from staylift.functions.names import region_of
from staylift.functions.prices import realised_price
from staylift.functions.text import fix_words
from staylift.operators import advert_timeline, adverts, bookings, cards, cooldown, lists, prompts, render, scoring, versions
from staylift.operators.copy import copy_rejects, last_copy, parse_copy, with_copy
from staylift.operators.filters import in_month, month_range, nonempty_regions, only_ids, with_recipient
from staylift.plans import booking_days, monthly, posted, weekly
from staylift.plans.approved import mail_approved, published_mails
from staylift.schemas import CLICK_REQUEST, NATIVE
from staylift.sources.contact_log import batch_name, merge_contacts, read_contact_log, read_contacts
from staylift.sources.outbox import as_outbox, read_outbox, write_outbox
from staylift.sources.tables import load_tables
from staylift.sources.templates import load_template
from staylift.sources.workspace import new_path
from staylift.streaming import approvals, clicks, contacts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def register(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = compose(sql)
        return fn

    return register


def _plain(df: DataFrame) -> DataFrame:
    """Rates as DOUBLE, the type the checking side reports them in."""
    return df.withColumn("advert_commission", F.col("advert_commission").cast("double"))


def _no_nulls(df: DataFrame) -> DataFrame:
    return df.fillna("").fillna(0)


# --- bookings per accommodation ---------------------------------------------------------------------


def _within(stamp: str, days: int) -> str:
    return f"re.{stamp} BETWEEN {o.NOW} - INTERVAL {days} DAY AND {o.NOW}"


def _window_sql(name: str, statuses: str, stamp: str, days: int) -> str:
    return f"CAST(count(*) FILTER (re.status IN ({statuses}) AND {_within(stamp, days)}) AS BIGINT) AS {name}"


WEEKLY_ACTIVITY = (
    f"""SELECT r.o_custkey AS acm_id, {_window_sql('booked', '1, 3, 6, 7, 8, 12', 'created_at', 90)},
    {_window_sql('confirmed', '7, 8', 'success_at', 180)}, {_window_sql('baseline', '7, 8', 'success_at', 90)},
    CAST(coalesce(sum({o.price('<> 0')}) FILTER (re.status IN (7, 8, 12) AND {_within('created_at', 90)}), 0) AS BIGINT) AS booked_gmv,
    CAST(coalesce(sum({o.price('<> 0')}) FILTER (re.status IN (7, 8) AND {_within('success_at', 180)}), 0) AS BIGINT) AS confirmed_gmv
    FROM u_res re JOIN orders r ON r.o_orderkey = re.room_id
    WHERE (re.status IN (7, 8) AND {_within('success_at', 180)}) OR {_within('created_at', 90)}
    GROUP BY r.o_custkey"""
)
MONTHLY_ACTIVITY = (
    "SELECT acm_id, res_this AS res_this_month, gmv_this AS gmv_this_month, res_last AS res_last_month, gmv_last AS gmv_last_month "
    "FROM m_month WHERE res_this + res_last > 0"
)


@query(WEEKLY_ACTIVITY)
def weekly_activity(spark: SparkSession, sf: str) -> DataFrame:
    t = b.upsell_tables(spark, sf)
    return bookings.weekly_activity(t.reservations, t.rooms, AS_OF, RULES)


@query(MONTHLY_ACTIVITY)
def monthly_activity(spark: SparkSession, sf: str) -> DataFrame:
    t = b.monthly_tables(spark, sf)
    return bookings.monthly_activity(t.reservations, t.rooms, AS_OF, RULES)


def _landed(reservations: DataFrame) -> DataFrame:
    """The bookings with some landed twice, and some beside the state they had before they were confirmed."""
    again = reservations.filter("room_id % 5 = 0")
    before = reservations.filter("room_id % 3 = 0").withColumns({"status": F.lit(3), "success_at": F.expr("success_at - INTERVAL 20 DAYS")})
    return reservations.unionByName(again).unionByName(before)


@query(WEEKLY_ACTIVITY)
def weekly_activity_of_versions(spark: SparkSession, sf: str) -> DataFrame:
    t = b.upsell_tables(spark, sf)
    return bookings.weekly_activity(versions.last_versions(_landed(t.reservations), "id", versions.LAST_BY["reservations"]), t.rooms, AS_OF, RULES)


@query(
    "SELECT CAST(copies AS BIGINT) AS copies, CAST(count(*) AS BIGINT) AS bookings "
    "FROM (SELECT 1 + (room_id % 5 = 0)::INT + (room_id % 3 = 0)::INT AS copies FROM u_res) WHERE copies > 1 GROUP BY copies"
)
def repeated_bookings(spark: SparkSession, sf: str) -> DataFrame:
    return versions.repeated(_landed(b.upsell_tables(spark, sf).reservations)).groupBy("copies").agg(F.count("*").alias("bookings"))


def _kept_days(reservations: DataFrame, first: date, last: date) -> str:
    """Daily sums kept over two runs: days as they stood before some bookings came in late and others were confirmed, then
    those days again that this changed. Days after ``last`` are left to the bookings."""
    path = new_path(reservations.sparkSession, "days")
    late = (F.dayofmonth("created_at") == 5) & (F.col("room_id") % 3 == 0)
    unconfirmed = (F.dayofmonth("success_at") == 20) & F.col("status").isin(*RULES.confirmed_statuses)
    before = reservations.filter(~late).withColumns(
        {"status": F.when(unconfirmed, 1).otherwise(F.col("status")), "success_at": F.when(~unconfirmed, F.col("success_at"))}
    )
    booking_days.state_days(before, path, batch_name(1), [first + timedelta(days=k) for k in range((last - first).days + 1)])
    changes = reservations.filter(late | unconfirmed)
    days = [d for d in booking_days.changed_days(changes) if first <= d <= last]
    booking_days.state_days(reservations, path, batch_name(2), days)
    return path


@query(WEEKLY_ACTIVITY)
def weekly_activity_from_days(spark: SparkSession, sf: str) -> DataFrame:
    t = b.upsell_tables(spark, sf)
    path = _kept_days(t.reservations, (AS_OF - timedelta(days=170)).date(), (AS_OF - timedelta(days=4)).date())
    return booking_days.weekly_activity(t.reservations, t.rooms, path, AS_OF, RULES)


@query(MONTHLY_ACTIVITY)
def monthly_activity_from_days(spark: SparkSession, sf: str) -> DataFrame:
    t = b.monthly_tables(spark, sf)
    path = _kept_days(t.reservations, (AS_OF - timedelta(days=100)).date(), (AS_OF - timedelta(days=20)).date())
    return booking_days.monthly_activity(t.reservations, t.rooms, path, AS_OF, RULES)


# --- weekly: targets -------------------------------------------------------------------------------


@query("SELECT * FROM u_no_ad_200")
def no_ad_targets(spark: SparkSession, sf: str) -> DataFrame:
    return weekly.no_ad_targets(b.upsell_tables(spark, sf), AS_OF, RULES)


NO_AD_SCORED = ["acm_id", "acm_name", "region", "res_90d", "gmv_90d", "grade", "target_type", "rec_package", "rec_rate", "extra_rev_90d"]


@query(f"SELECT {', '.join(NO_AD_SCORED)} FROM u_no_ad_scored")
def no_ad_targets_scored(spark: SparkSession, sf: str) -> DataFrame:
    found = weekly.no_ad_targets(b.upsell_tables(spark, sf), AS_OF, RULES, None)
    return scoring.score_targets(found, "no_ad", RULES.packages).select(*NO_AD_SCORED)


@query(
    f"SELECT acm_id, res_90d, gmv_90d, {o.GRADE} AS grade, CAST(trunc(gmv_90d * 0.15::DOUBLE) AS BIGINT) AS extra_rev_90d FROM u_no_ad_365"
)
def no_ad_scored_365(spark: SparkSession, sf: str) -> DataFrame:
    found = weekly.no_ad_targets(b.upsell_tables(spark, sf), AS_OF, replace(RULES, no_ad_days=365), None)
    scored = scoring.score_targets(found, "no_ad", RULES.packages)
    return scored.select("acm_id", "res_90d", "gmv_90d", "grade", "extra_rev_90d")


@query("SELECT * EXCLUDE (advert_commission), advert_commission::DOUBLE AS advert_commission FROM u_upgrade_20")
def upgrade_targets(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(weekly.upgrade_targets(b.upsell_tables(spark, sf), AS_OF, RULES))


@query("SELECT * EXCLUDE (advert_commission), advert_commission::DOUBLE AS advert_commission FROM u_upgrade_scored")
def upgrade_scored(spark: SparkSession, sf: str) -> DataFrame:
    found = weekly.upgrade_targets(b.upsell_tables(spark, sf), AS_OF, RULES, None)
    return _plain(scoring.score_targets(found, "upgrade", RULES.packages))


@query(
    "SELECT acm_id AS accommodation_id, advert_name, rate::DOUBLE AS advert_commission, success_at, "
    "coalesce(expiration_at::VARCHAR, '') AS expires FROM u_active"
)
def active_adverts(spark: SparkSession, sf: str) -> DataFrame:
    active = adverts.active_adverts(b.upsell_tables(spark, sf).accommodation_adverts, AS_OF)
    expires = F.coalesce(F.date_format("expiration_at", "yyyy-MM-dd HH:mm:ss"), F.lit(""))
    return _plain(active).select("accommodation_id", "advert_name", "advert_commission", "success_at", expires.alias("expires"))


@query(
    "SELECT acm_id, advert_name, rate::DOUBLE AS advert_commission, success_at, CAST(count(*) AS BIGINT) AS copies "
    "FROM m_latest GROUP BY ALL"
)
def latest_advert(spark: SparkSession, sf: str) -> DataFrame:
    active = adverts.active_adverts(b.monthly_tables(spark, sf).accommodation_adverts, AS_OF)
    return _plain(adverts.latest_advert(adverts.commission_at_least(active, RULES.report_min_rate)))


#: The fifteenth of the twelve months up to now.
REPLAYED = [AS_OF.replace(year=AS_OF.year - (m > AS_OF.month), month=m) for m in range(1, 13)]
REPLAY_SQL = "(SELECT unnest([{}]) AS as_of) d".format(", ".join(f"TIMESTAMP '{m:%Y-%m-%d}'" for m in REPLAYED))
RUNS_THEN = "success_at <= d.as_of AND (expiration_at IS NULL OR expiration_at > d.as_of)"


@query(
    "SELECT as_of, acm_id, advert_name, advert_commission FROM (SELECT DISTINCT d.as_of, acm_id, advert_name, rate::DOUBLE AS advert_commission, "
    f"max(rate) OVER (PARTITION BY d.as_of, acm_id) = rate AS best FROM u_advert, {REPLAY_SQL} WHERE {RUNS_THEN} AND rate <= 0.15) WHERE best"
)
def best_adverts_replayed(spark: SparkSession, sf: str) -> DataFrame:
    low = adverts.commission_at_most(b.upsell_tables(spark, sf).accommodation_adverts, RULES.upgrade_max_rate)
    return _plain(advert_timeline.replayed(advert_timeline.best_timeline(low), REPLAYED))


@query(
    "SELECT as_of, acm_id, advert_name, rate::DOUBLE AS advert_commission, success_at, CAST(count(*) AS BIGINT) AS copies "
    "FROM (SELECT d.as_of, u.*, max(success_at) OVER (PARTITION BY d.as_of, acm_id) AS newest "
    f"FROM u_advert u, {REPLAY_SQL} WHERE {RUNS_THEN}) WHERE success_at = newest GROUP BY ALL"
)
def latest_adverts_replayed(spark: SparkSession, sf: str) -> DataFrame:
    found = b.upsell_tables(spark, sf).accommodation_adverts
    return _plain(advert_timeline.replayed(advert_timeline.latest_timeline(found), REPLAYED))


@query(
    "SELECT * EXCLUDE (advert_commission), advert_commission::DOUBLE AS advert_commission FROM u_upgrade_20"
)
def upgrade_targets_by_timeline(spark: SparkSession, sf: str) -> DataFrame:
    t = b.upsell_tables(spark, sf)
    low = advert_timeline.best_timeline(adverts.commission_at_most(t.accommodation_adverts, RULES.upgrade_max_rate))
    return _plain(weekly.upgrade_targets(t, AS_OF, RULES, tiers=advert_timeline.counting_on(low, AS_OF)))


def _all_regions(t) -> DataFrame:
    return nonempty_regions(t.accommodations.select(region_of(F.col("name_expression")).alias("region")))


@query("SELECT region, CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE total / n END AS avg_res, n AS ad_acm_cnt FROM u_base")
def region_ad_baseline(spark: SparkSession, sf: str) -> DataFrame:
    t = b.upsell_tables(spark, sf)
    return weekly.region_ad_baseline(t, AS_OF, _all_regions(t), RULES)


@query(
    "SELECT g.region, coalesce(avg(s.res), 0) AS avg_res, CAST(count(s.id) AS BIGINT) AS ad_acm_cnt FROM u_region g "
    "LEFT JOIN u_ad_res s ON string_split(string_split(s.name, '/')[1], '[')[-1] = g.region GROUP BY g.region"
)
def region_ad_baseline_exact(spark: SparkSession, sf: str) -> DataFrame:
    t = b.upsell_tables(spark, sf)
    return weekly.region_ad_baseline(t, AS_OF, _all_regions(t), RULES, match="exact")


@query("SELECT id AS acm_id, string_split(string_split(name, '/')[1], '[')[-1] AS region FROM u_acm")
def region_of_name(spark: SparkSession, sf: str) -> DataFrame:
    acm = b.upsell_tables(spark, sf).accommodations
    return acm.select(F.col("id").alias("acm_id"), region_of(F.col("name_expression")).alias("region"))


@query("SELECT grade, CAST(count(*) AS BIGINT) AS targets FROM u_all GROUP BY grade")
def grade_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return lists.histogram(_all_scored(spark, sf), "grade")


def _all_scored(spark: SparkSession, sf: str) -> DataFrame:
    """Both scored lists without a limit."""
    t = b.upsell_tables(spark, sf)
    no_ad = scoring.score_targets(weekly.no_ad_targets(t, AS_OF, RULES, None), "no_ad", RULES.packages)
    upgrade = scoring.score_targets(weekly.upgrade_targets(t, AS_OF, RULES, None), "upgrade", RULES.packages)
    return no_ad.withColumn("list_no", F.lit(1)).unionByName(upgrade.withColumn("list_no", F.lit(2)))


def _all_targets(spark: SparkSession, sf: str) -> DataFrame:
    """The same with their region's figures."""
    t = b.upsell_tables(spark, sf)
    return scoring.with_baseline(_all_scored(spark, sf), weekly.region_ad_baseline(t, AS_OF, _all_regions(t), RULES))


o.CTES["u_no_ad_compat"] = f"""
    SELECT n.acm_id, n.acm_name, p.phone AS host_phone, n.res_90d, n.gmv_90d
    FROM u_no_ad n JOIN u_acm a ON a.id = n.acm_id
    LEFT JOIN (SELECT c_custkey AS id, unnest({o.phones_of('c_custkey')}) AS phone FROM customer WHERE c_custkey % 13 <> 5) p ON p.id = a.owner"""


@query("SELECT acm_id, acm_name, host_phone, res_90d, gmv_90d FROM u_no_ad_compat", "no_ad_targets_compat")
def no_ad_targets_with_repeated_phones(spark: SparkSession, sf: str) -> DataFrame:
    found = weekly.no_ad_targets(b.upsell_tables(spark, sf), AS_OF, RULES, None, compat=True)
    return found.select("acm_id", "acm_name", "host_phone", "res_90d", "gmv_90d")


@query("SELECT list_no, acm_id, res_90d FROM u_listed WHERE target_type = 'upgrade'")
def report_split(spark: SparkSession, sf: str) -> DataFrame:
    return lists.split_list(_limited(spark, sf), "upgrade").select("list_no", "acm_id", "res_90d")


def _limited(spark: SparkSession, sf: str) -> DataFrame:
    return weekly.weekly_targets(b.upsell_tables(spark, sf), AS_OF, RULES)


@query(
    "SELECT list_no, pos, acm_id, grade, target_type, res_90d, extra_rev_90d, "
    "CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE total / n END AS avg_res, n AS ad_acm_cnt FROM u_listed"
)
def report_union(spark: SparkSession, sf: str) -> DataFrame:
    return _limited(spark, sf).select(
        "list_no", "pos", "acm_id", "grade", "target_type", "res_90d", "extra_rev_90d", "avg_res", "ad_acm_cnt"
    )


@query(
    "SELECT overall, list_no, pos, acm_id, grade, res_90d FROM (SELECT *, CAST(row_number() OVER (ORDER BY list_no, pos) AS INT) AS overall FROM u_listed) "
    "WHERE overall <= 30"
)
def candidates_30(spark: SparkSession, sf: str) -> DataFrame:
    return lists.candidates(_limited(spark, sf)).select("overall", "list_no", "pos", "acm_id", "grade", "res_90d")


@query(
    "SELECT CAST(part AS INT) AS part, string_agg(acm_id::VARCHAR, ',' ORDER BY nth) AS acm_ids, CAST(count(*) AS BIGINT) AS id_count "
    "FROM (SELECT *, (nth - 1) // 100 + 1 AS part FROM (SELECT acm_id, row_number() OVER (ORDER BY list_no, res_90d DESC, acm_id, advert_name NULLS FIRST) AS nth "
    "FROM u_all WHERE grade IN ('A', 'B'))) GROUP BY part"
)
def bulk_ids(spark: SparkSession, sf: str) -> DataFrame:
    """All of the uncapped lists, numbered by ranges, a hundred ids a row."""
    approvable = _all_scored(spark, sf).filter(F.col("grade").isin("A", "B")).withColumn("less", -F.col("res_90d"))
    return lists.bulk_ids(approvable.withColumn("advert", F.coalesce("advert_name", F.lit(""))), ["list_no", "less", "acm_id", "advert"], limited=False, size=100)


@query("SELECT acm_id, acm_name, res_90d FROM u_no_ad WHERE acm_id IN (SELECT acm_id FROM k_approved)", "only_ids")
def only_approved(spark: SparkSession, sf: str) -> DataFrame:
    found = weekly.no_ad_targets(b.upsell_tables(spark, sf), AS_OF, RULES, None)
    return only_ids(found, _approved(spark, sf)).select("acm_id", "acm_name", "res_90d")


# --- monthly ---------------------------------------------------------------------------------------


@query("SELECT * EXCLUDE (advert_commission), advert_commission::DOUBLE AS advert_commission FROM m_listed")
def monthly_hosts(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(monthly.monthly_ad_hosts(b.monthly_tables(spark, sf), AS_OF, RULES))


@query("SELECT * EXCLUDE (advert_commission), advert_commission::DOUBLE AS advert_commission FROM m_fanout")
def monthly_hosts_fanout(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(monthly.monthly_ad_hosts(b.monthly_tables(spark, sf), AS_OF, RULES, None, fanout_compat=True))


@query(
    "SELECT region, CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE total / n END AS avg_res, round(avg_price, 2) AS avg_price_per_res, n AS ad_acm_cnt FROM m_base"
)
def region_month_baseline(spark: SparkSession, sf: str) -> DataFrame:
    t = b.monthly_tables(spark, sf)
    baseline = monthly.region_month_baseline(t, AS_OF, _all_regions(t), RULES)
    return baseline.withColumn("avg_price_per_res", F.round("avg_price_per_res", 2))


MONTHLY_SCORED = [
    "acm_id", "advert_name", "res_this_month", "res_last_month", "gmv_this_month", "perf", "change_pct", "host_price_per_res",
    "region_avg_price", "price_high", "consecutive_zero",
]


def _all_hosts(spark: SparkSession, sf: str) -> DataFrame:
    """Scored hosts without a limit."""
    t = b.monthly_tables(spark, sf)
    found = monthly.monthly_ad_hosts(t, AS_OF, RULES, None)
    return scoring.score_hosts(found, monthly.region_month_baseline(t, AS_OF, _all_regions(t), RULES))


def _limited_hosts(spark: SparkSession, sf: str) -> DataFrame:
    return monthly.monthly_hosts(b.monthly_tables(spark, sf), AS_OF, RULES)


@query(f"SELECT {', '.join(MONTHLY_SCORED)}, {o.mean_text('total', 'n')}::DOUBLE AS region_avg_res FROM m_scored_all")
def monthly_scored(spark: SparkSession, sf: str) -> DataFrame:
    return _all_hosts(spark, sf).select(*MONTHLY_SCORED, "region_avg_res")


@query("SELECT perf, CAST(count(*) AS BIGINT) AS targets FROM m_scored_all GROUP BY perf")
def perf_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return lists.histogram(_all_hosts(spark, sf), "perf")


U_MONTHLY = f"""
SELECT h.acm_id, h.acm_name, aa.advert_name, aa.rate AS advert_commission, h.host_email, h.host_phone
FROM u_host h
JOIN (SELECT DISTINCT a.acm_id, a.advert_name, a.rate FROM u_active a JOIN (SELECT acm_id, max(success_at) AS newest FROM u_active WHERE rate >= 0.15 GROUP BY acm_id) t
  ON t.acm_id = a.acm_id AND t.newest = a.success_at WHERE a.rate >= 0.15) aa ON aa.acm_id = h.acm_id
WHERE NOT EXISTS (SELECT 1 FROM orders r JOIN u_res re ON re.room_id = r.o_orderkey WHERE r.o_custkey = h.acm_id AND re.status IN (7, 8)
  AND re.success_at >= TIMESTAMP '1997-11-01' AND re.success_at < TIMESTAMP '1998-01-01')"""


@query(f"SELECT acm_id, advert_name, {o.DIRECT_CALL} AS line FROM ({U_MONTHLY})")
def consecutive_zero_hosts(spark: SparkSession, sf: str) -> DataFrame:
    t = b.upsell_tables(spark, sf)
    found = monthly.monthly_ad_hosts(t, AS_OF, RULES, None)
    scored = scoring.score_hosts(found, monthly.region_month_baseline(t, AS_OF, _all_regions(t), RULES, match="exact"))
    return scoring.needs_direct_call(scored).select("acm_id", "advert_name", cards.direct_call_line().alias("line"))


@query(
    f"SELECT acm_id, advert_name, {o.OFFER_NAME} AS offer_package, {o.OFFER_EXTRA} AS offer_benefits FROM m_scored_all "
    "WHERE perf = 'growth' AND advert_commission IN (0.15, 0.20)"
)
def upgrade_offers(spark: SparkSession, sf: str) -> DataFrame:
    offers = prompts.upgrade_offers(_all_hosts(spark, sf), RULES.packages)
    return offers.select("acm_id", "advert_name", "offer_package", "offer_benefits")


@query(f"SELECT acm_id, advert_name, {o.PRICE_ADVICE} AS advice FROM m_scored_all WHERE {o.WANTS_ADVICE}")
def price_advice(spark: SparkSession, sf: str) -> DataFrame:
    advised = _all_hosts(spark, sf).filter(
        scoring.wants_price_advice(F.col("perf"), F.col("price_high"), F.col("region_avg_price"))
    )
    text = prompts.price_advice(F.col("host_price_per_res"), F.col("region_avg_price"))
    return advised.select("acm_id", "advert_name", text.alias("advice"))


# --- contact log and cool-down ---------------------------------------------------------------------


@query(
    "SELECT user_id AS acm_id, max(ts) AS last_shown FROM events WHERE event_type IN ('click', 'purchase') GROUP BY user_id"
)
def contact_log_merge(spark: SparkSession, sf: str) -> DataFrame:
    bought = b.read(spark, sf, "events").filter(F.col("event_type") == "purchase")
    new = bought.select(F.col("user_id").alias("acm_id"), F.col("ts").alias("last_shown"))
    return merge_contacts(b.shown_log(spark, sf), new, "acm_id", "last_shown")


def _partners(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Every accommodation with its address, and the users."""
    t = b.upsell_tables(spark, sf)
    addressed = t.users.select(F.col("id").alias("user_id"), F.col("email").alias("host_email"))
    acm = t.accommodations.select(F.col("id").alias("acm_id"), F.col("name_expression").alias("acm_name"), "user_id")
    return acm.join(addressed, "user_id", "left").drop("user_id"), t.users


PARTNERS = "(SELECT a.id AS acm_id, a.name AS acm_name, u.email AS host_email FROM u_acm a LEFT JOIN u_user u ON u.id = a.owner) p"
E_NOW = o.CONTACTS_NOW


@query(f"SELECT acm_id, acm_name FROM {PARTNERS} WHERE acm_id NOT IN (SELECT acm_id FROM e_shown WHERE {E_NOW} - last_shown < INTERVAL 7 DAY)")
def cooldown_shown_7(spark: SparkSession, sf: str) -> DataFrame:
    partners, _ = _partners(spark, sf)
    passed = cooldown.not_recently_shown(partners, b.shown_log(spark, sf), CONTACTS_AS_OF, 7)
    return passed.select("acm_id", "acm_name")


def _pending(spark: SparkSession, sf: str, days: int) -> DataFrame:
    partners, users = _partners(spark, sf)
    return cooldown.pending(partners, b.sent_log(spark, sf, users), CONTACTS_AS_OF, days).select("acm_id", "host_email")


def _pending_sql(days: int) -> str:
    return (
        f"SELECT p.acm_id, p.host_email FROM {PARTNERS} LEFT JOIN e_sent s ON s.email = p.host_email "
        f"WHERE p.host_email IS NOT NULL AND p.host_email <> '' AND (s.last_sent IS NULL OR {E_NOW} - INTERVAL {days} DAY > s.last_sent)"
    )


@query(_pending_sql(14))
def cooldown_pending_14(spark: SparkSession, sf: str) -> DataFrame:
    return _pending(spark, sf, 14)


@query(_pending_sql(25))
def cooldown_pending_25(spark: SparkSession, sf: str) -> DataFrame:
    return _pending(spark, sf, 25)


BLOCKED = (
    "SELECT p.acm_id, p.acm_name, p.host_email, coalesce(strftime(s.last_sent + INTERVAL 14 DAY, '%Y-%m-%d'), '알 수 없음') AS next_available "
    f"FROM {PARTNERS} LEFT JOIN e_sent s ON s.email = p.host_email "
    f"WHERE p.host_email IS NULL OR p.host_email = '' OR s.last_sent >= {E_NOW} - INTERVAL 14 DAY"
)


@query(f"SELECT acm_id, next_available FROM ({BLOCKED})")
def cooldown_blocked_14(spark: SparkSession, sf: str) -> DataFrame:
    partners, users = _partners(spark, sf)
    stopped = cooldown.blocked(partners, b.sent_log(spark, sf, users), CONTACTS_AS_OF, 14)
    return stopped.select("acm_id", "next_available")


def _judged_partners(spark: SparkSession, sf: str) -> DataFrame:
    partners, users = _partners(spark, sf)
    addressed = with_recipient(partners.withColumn("subject", F.col("acm_name")))
    return cooldown.with_outcome(addressed, b.sent_log(spark, sf, users), CONTACTS_AS_OF, 14)


#: Delivery reports on every third mail; of each second of these the first try failed, and of each fourth the second too.
_OUTCOME = (
    f"SELECT p.*, CASE WHEN p.host_email IS NULL OR s.last_sent >= {E_NOW} - INTERVAL 14 DAY THEN 'skip' WHEN p.acm_id % 12 = 0 THEN 'fail' "
    f"ELSE 'success' END AS outcome FROM {PARTNERS} LEFT JOIN e_sent s ON s.email = p.host_email"
)


def _delivered(spark: SparkSession, sf: str) -> DataFrame:
    judged = _judged_partners(spark, sf)
    tries = judged.filter("recipient IS NOT NULL AND acm_id % 3 = 0").select(
        "acm_id", "recipient", F.explode(F.array(F.col("acm_id") % 2 != 0, F.col("acm_id") % 4 != 0)).alias("delivered")
    )
    return cooldown.with_deliveries(judged, tries)


@query(f"SELECT outcome, CAST(count(*) AS BIGINT) AS mails FROM ({_OUTCOME}) GROUP BY 1")
def batch_outcome(spark: SparkSession, sf: str) -> DataFrame:
    return cooldown.batch_outcome(_delivered(spark, sf))


@query(f"SELECT DISTINCT host_email AS email, {E_NOW} AS last_sent FROM ({_OUTCOME}) WHERE outcome = 'success'")
def mark_sent(spark: SparkSession, sf: str) -> DataFrame:
    return cooldown.mark_sent(_delivered(spark, sf), CONTACTS_AS_OF)


@query("SELECT DISTINCT acm_id, TIMESTAMP '1998-01-15' AS last_shown FROM u_all")
def mark_shown(spark: SparkSession, sf: str) -> DataFrame:
    return cooldown.mark_shown(_all_scored(spark, sf), AS_OF)


# --- scalars ---------------------------------------------------------------------------------------

LADDER = {
    "sp": "CASE WHEN l_linenumber = 3 THEN NULL WHEN l_linenumber = 5 THEN -1 * {ext} WHEN l_linenumber % 3 = 0 THEN {ext} ELSE 0 END",
    "ts": "CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber % 2 = 0 THEN 0 ELSE {ext} - 1 END",
}
_EXT = {name: text.format(ext="CAST(l_extendedprice AS DECIMAL(14,2))") for name, text in LADDER.items()}


def _ladder_sql(test: str) -> str:
    return (
        f"CASE WHEN {_EXT['sp']} {test} THEN round({_EXT['sp']}, 0) WHEN {_EXT['ts']} = 0 THEN round(CAST(l_extendedprice AS DECIMAL(14,2)), 0) "
        f"ELSE round({_EXT['ts']}, 0) END"
    )


@query(
    f"SELECT l_linenumber, l_returnflag, CAST(sum({_ladder_sql('<> 0')}) AS BIGINT) AS any_set, CAST(sum({_ladder_sql('> 0')}) AS BIGINT) AS positive, "
    f"CAST(count({_ladder_sql('<> 0')}) AS BIGINT) AS priced FROM lineitem GROUP BY ALL HAVING sum({_ladder_sql('> 0')}) IS NOT NULL"
)
def price_ladder(spark: SparkSession, sf: str) -> DataFrame:
    prices = b.read(spark, sf, "lineitem").selectExpr(
        "l_linenumber", "l_returnflag", "CAST(l_extendedprice AS DECIMAL(14,2)) AS total_price",
        f"CAST({_EXT['sp']} AS DECIMAL(14,2)) AS suggestion_price", f"CAST({_EXT['ts']} AS DECIMAL(14,2)) AS total_price_set",
    )
    priced = prices.select(
        "l_linenumber", "l_returnflag",
        realised_price(positive_only=False).alias("a"), realised_price(positive_only=True).alias("p"),
    )
    sums = priced.groupBy("l_linenumber", "l_returnflag").agg(
        F.sum("a").alias("any_set"), F.sum("p").alias("positive"), F.count("a").alias("priced")
    )
    return sums.filter(F.col("positive").isNotNull())


@query(f"SELECT id AS user_id, {o.phone('phone')} AS phone FROM u_user WHERE phone IS NOT NULL")
def phone_format(spark: SparkSession, sf: str) -> DataFrame:
    infos = b.upsell_tables(spark, sf).user_infos
    smallest = infos.groupBy("user_id").agg(F.min("phone_number").alias("number"))
    return smallest.select("user_id", fmt.phone(F.col("number")).alias("phone"))


_BALANCE = "CAST(c_acctbal AS DECIMAL(14,2))"


@query(
    f"SELECT c_custkey, format('{{:,}}', CAST(trunc({_BALANCE} * 1000) AS BIGINT)) AS amount, "
    f"printf('%.1f', round({_BALANCE}, 1)::DOUBLE) AS one_dp, "
    f"CASE WHEN c_acctbal > 0 THEN '▲ ' || printf('%.1f', round({_BALANCE}, 1)::DOUBLE) || '%' WHEN c_acctbal < 0 THEN '▼ ' || "
    f"printf('%.1f', abs(round({_BALANCE}, 1)::DOUBLE)) || '%' ELSE '—' END AS arrow FROM customer"
)
def amount_format(spark: SparkSession, sf: str) -> DataFrame:
    balance = F.col("c_acctbal")
    thousandfold = balance.cast("decimal(14,2)") * 1000
    return b.read(spark, sf, "customer").select(
        "c_custkey", fmt.thousands(thousandfold).alias("amount"), fmt.one_decimal(balance).alias("one_dp"),
        fmt.change_arrow(balance).alias("arrow"),
    )


@query(
    "SELECT year(o_orderdate) || '년 ' || month(o_orderdate) || '월' AS label, CAST(count(*) AS BIGINT) AS orders FROM orders GROUP BY 1"
)
def month_label(spark: SparkSession, sf: str) -> DataFrame:
    label = fmt.month_label(F.col("o_orderdate"))
    return b.read(spark, sf, "orders").groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("orders"))


@query(
    "SELECT '1997-12-01' AS first_day, '1997-12-31' AS last_day, CAST(count(*) AS BIGINT) AS orders FROM orders "
    "WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-12-01' AND DATE '1997-12-31'"
)
def orders_of_last_month(spark: SparkSession, sf: str) -> DataFrame:
    first, last = month_range(AS_OF, 1)
    found = b.read(spark, sf, "orders").filter(in_month("o_orderdate", AS_OF, 1)).agg(F.count(F.lit(1)).alias("orders"))
    return found.select(first.cast("string").alias("first_day"), last.cast("string").alias("last_day"), "orders")


# --- texts -----------------------------------------------------------------------------------------


@query(f"SELECT acm_id, {o.UPSELL_PROMPT} AS prompt FROM u_all")
def prompts_upsell(spark: SparkSession, sf: str) -> DataFrame:
    return prompts.upsell_prompts(_all_targets(spark, sf), RULES)


@query(f"SELECT acm_id, advert_name, {o.REPORT_PROMPT} AS prompt FROM m_scored_all")
def prompts_report(spark: SparkSession, sf: str) -> DataFrame:
    return prompts.report_prompts(_all_hosts(spark, sf), monthly.report_month(AS_OF), RULES)


@query(
    f"SELECT 'upsell' AS report, {o.UPSELL_SUMMARY} AS prompt FROM (SELECT * FROM u_listed ORDER BY list_no, pos LIMIT 20) "
    f"UNION ALL SELECT 'monthly', {o.REPORT_SUMMARY} FROM m_scored"
)
def summary_prompts(spark: SparkSession, sf: str) -> DataFrame:
    upsell = prompts.upsell_summary_prompt(_limited(spark, sf))
    month = prompts.report_summary_prompt(_limited_hosts(spark, sf), monthly.report_month(AS_OF))
    return upsell.select(F.lit("upsell").alias("report"), "prompt").unionByName(
        month.select(F.lit("monthly").alias("report"), "prompt")
    )


@query(
    f"SELECT acm_id, turn, {o.fixed(chr(39) + 'coupon ' + chr(39) + ' || role || ' + chr(39) + ' Package' + chr(39))} AS subject, {o.fixed('text')} AS body "
    "FROM (SELECT p.acm_id, p.turn, v.role, v.text FROM c_parsed p JOIN conversations v ON v.conv_id = p.acm_id AND v.turn = p.turn WHERE p.usable)",
    "parse_copy",
)
def parse_copy_texts(spark: SparkSession, sf: str) -> DataFrame:
    return parse_copy(b.conversation_responses(spark, sf))


@query("SELECT acm_id, turn, length(response) AS size FROM c_parsed WHERE NOT usable")
def parse_copy_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return copy_rejects(b.conversation_responses(spark, sf)).select("acm_id", "turn", F.length("response").cast("long").alias("size"))


@query(
    f"SELECT acm_id, {o.fixed(chr(39) + 'coupon ' + chr(39) + ' || role || ' + chr(39) + ' Package' + chr(39))} AS subject, {o.fixed('text')} AS body "
    "FROM (SELECT p.acm_id, v.role, v.text, row_number() OVER (PARTITION BY p.acm_id ORDER BY p.turn DESC) AS nth FROM c_parsed p "
    "JOIN conversations v ON v.conv_id = p.acm_id AND v.turn = p.turn WHERE p.usable) WHERE nth = 1",
    "last_copy",
)
def last_copy_of_each(spark: SparkSession, sf: str) -> DataFrame:
    return last_copy(parse_copy(b.conversation_responses(spark, sf)), "turn")


_PLANTED = "'coupon 쿠pon이 이ven트 PUSH Marketing packages ' || role || ' ' || text"


@query(f"SELECT conv_id, turn, {o.fixed(_PLANTED)} AS fixed FROM conversations", "fix_words")
def fix_words_in_turns(spark: SparkSession, sf: str) -> DataFrame:
    turns = b.read(spark, sf, "conversations")
    return turns.select("conv_id", "turn", fix_words(F.expr(_PLANTED)).alias("fixed"))


def _upsell_copy(spark: SparkSession, sf: str) -> DataFrame:
    """Raw responses, several an id; ``made`` orders them."""
    return b.partner_responses(b.read(spark, sf, "customer"), "c_custkey", "c_name")


def _monthly_copy(spark: SparkSession, sf: str) -> DataFrame:
    return b.partner_responses(b.read(spark, sf, "supplier"), "s_suppkey", "s_name")


@query(f"SELECT t.acm_id, {o.UPSELL_HTML} AS html FROM u_all t JOIN u_copy c ON c.acm_id = t.acm_id".replace("acm_id::VARCHAR", "t.acm_id::VARCHAR"))
def render_upsell(spark: SparkSession, sf: str) -> DataFrame:
    mails = with_copy(_all_targets(spark, sf), _upsell_copy(spark, sf), required=True, order="made")
    return render.render_upsell(mails, o.UPSELL_TEMPLATE).select("acm_id", "html")


@query(
    f"SELECT t.acm_id, {o.REPORT_HTML} AS html FROM m_scored_all t JOIN m_copy c ON c.acm_id = t.acm_id".replace("acm_id::VARCHAR", "t.acm_id::VARCHAR")
)
def render_report(spark: SparkSession, sf: str) -> DataFrame:
    mails = with_copy(_all_hosts(spark, sf), _monthly_copy(spark, sf), required=True, order="made")
    return render.render_report(mails, o.REPORT_TEMPLATE, monthly.report_month(AS_OF)).select("acm_id", "html")


U_CARDS = "(SELECT t.*, c.subject, c.body, c.acm_id IS NOT NULL AS has_copy FROM u_listed t LEFT JOIN u_copy c ON c.acm_id = t.acm_id)"
M_CARDS = "(SELECT t.*, c.subject, c.body, c.acm_id IS NOT NULL AS has_copy FROM m_scored t LEFT JOIN m_copy c ON c.acm_id = t.acm_id)"


@query(f"SELECT list_no, pos, acm_id, has_copy, {o.UPSELL_CARD} AS card FROM {U_CARDS} WHERE pos <= CASE list_no WHEN 1 THEN 15 ELSE 10 END")
def cards_upsell(spark: SparkSession, sf: str) -> DataFrame:
    return cards.upsell_cards(with_copy(_limited(spark, sf), _upsell_copy(spark, sf), required=False, order="made"))


@query(f"SELECT pos, acm_id, has_copy, {o.REPORT_CARD} AS card FROM {M_CARDS} WHERE pos <= 20")
def cards_report(spark: SparkSession, sf: str) -> DataFrame:
    return cards.report_cards(with_copy(_limited_hosts(spark, sf), _monthly_copy(spark, sf), required=False, order="made"))


U_ALL_COPY = "(SELECT t.*, c.subject, c.body FROM u_all t JOIN u_copy c ON c.acm_id = t.acm_id)"


@query(f"SELECT acm_id, {o.review('offer')} AS review FROM {U_ALL_COPY}")
def review_texts(spark: SparkSession, sf: str) -> DataFrame:
    return cards.review_texts(with_copy(_all_targets(spark, sf), _upsell_copy(spark, sf), required=False, order="made"))


@query(
    f"SELECT acm_id, {o.NOTICE} AS notice FROM w_mail_all WHERE outcome = 'skip' "
    "UNION ALL SELECT 0, 'Not mailed yet: ' || count(*) FROM w_mail_all WHERE outcome = 'skip' HAVING count(*) > 0"
)
def blocked_notice(spark: SparkSession, sf: str) -> DataFrame:
    skipped = _weekly_mail_all(spark, sf).filter(F.col("outcome") == "skip")
    heading = cards.blocked_heading(skipped).select(F.lit(0).cast("long").alias("acm_id"), F.col("heading").alias("notice"))
    return cards.blocked_notices(skipped).select("acm_id", "notice").unionByName(heading)


# --- clicks ----------------------------------------------------------------------------------------


def _clicks(spark: SparkSession, sf: str) -> DataFrame:
    return b.as_clicks(b.read(spark, sf, "events"))


def _approved(spark: SparkSession, sf: str) -> DataFrame:
    return clicks.explode_approvals(clicks.route_clicks(clicks.fresh_clicks(_clicks(spark, sf))))


@query("SELECT click_id, arrived_at FROM k_fresh")
def clicks_fresh(spark: SparkSession, sf: str) -> DataFrame:
    return clicks.fresh_clicks(_clicks(spark, sf)).select("click_id", "arrived_at")


@query("SELECT click_id, arrived_at, action_id, acm_ids, workflow, test_mode FROM k_routed")
def clicks_routed(spark: SparkSession, sf: str) -> DataFrame:
    return clicks.route_clicks(clicks.fresh_clicks(_clicks(spark, sf)))


@query("SELECT click_id, arrived_at, workflow, test_mode, bulk_size, acm_id FROM k_approved")
def approvals_exploded(spark: SparkSession, sf: str) -> DataFrame:
    return _approved(spark, sf)


# --- whole jobs ------------------------------------------------------------------------------------

SHIFT_DAYS = (CONTACTS_AS_OF - AS_OF).days


def _shifted(log: DataFrame, stamp: str) -> DataFrame:
    """Contacts moved to the time of the bookings."""
    return log.withColumn(stamp, F.col(stamp) - F.make_dt_interval(days=F.lit(SHIFT_DAYS)))


def _report_sql(workflow: str, kind: str, source: str, body: str) -> str:
    return (
        f"SELECT '1998-01-15' AS run_date, '{workflow}' AS workflow, '{kind}' AS kind, list_no, pos, acm_id, coalesce(host_email, '') AS recipient, "
        f"coalesce(subject, '') AS subject, {body} AS body FROM {source}"
    )


def _single_sql(workflow: str, kind: str, source: str, body: str) -> str:
    return f"SELECT '1998-01-15', '{workflow}', '{kind}', 0, 0, 0, '', '', {body} FROM {source}"


def _outbox(df: DataFrame) -> DataFrame:
    return _no_nulls(df.drop("outcome"))


def _bulk_sql(workflow: str, source: str, order: str) -> str:
    return f"SELECT '1998-01-15', '{workflow}', 'bulk', 0, 1, 0, '', '', string_agg(acm_id::VARCHAR, ',' ORDER BY {order}) FROM {source} HAVING count(*) > 0"


@query(
    _report_sql("weekly_upsell", "card", "w_listed WHERE pos <= CASE list_no WHEN 1 THEN 15 ELSE 10 END", o.UPSELL_CARD)
    + " UNION ALL " + _report_sql("weekly_upsell", "review", "w_listed WHERE has_copy", o.review("offer"))
    + " UNION ALL " + _single_sql("weekly_upsell", "summary", "(SELECT * FROM w_listed ORDER BY list_no, pos LIMIT 20)", o.UPSELL_SUMMARY)
    + " UNION ALL " + _single_sql("weekly_upsell", "title", "(SELECT 1)", "'Hosts to write to, 1998-01-15'")
    + " UNION ALL " + _single_sql("weekly_upsell", "header", "w_listed", o.UPSELL_HEADER)
    + f" UNION ALL SELECT '1998-01-15', 'weekly_upsell', 'section', list_no, 0, 0, '', '', {o.HEADING} FROM w_listed GROUP BY list_no"
    + " UNION ALL " + _bulk_sql("weekly_upsell", "w_listed WHERE grade IN ('A', 'B')", "list_no, pos")
)
def weekly_report(spark: SparkSession, sf: str) -> DataFrame:
    log = _shifted(b.shown_log(spark, sf), "last_shown")
    targets = weekly.weekly_targets(b.upsell_tables(spark, sf), AS_OF, RULES, shown_log=log)
    return _outbox(weekly.weekly_report(targets, _upsell_copy(spark, sf), AS_OF, RULES, order="made"))


@query()
def posted_weekly_report(spark: SparkSession, sf: str) -> DataFrame:
    """The report as a published run, beside one that broke off before it was."""
    log, path = _shifted(b.shown_log(spark, sf), "last_shown"), new_path(spark, "posted")
    targets = weekly.weekly_targets(b.upsell_tables(spark, sf), AS_OF, RULES, shown_log=log)
    copies = _upsell_copy(spark, sf)
    weekly.weekly_report(targets, copies, AS_OF, RULES, order="made").write.parquet(f"{path}/reports/run=broken off")
    posted.post_weekly_report(spark, path, "posted", targets, copies, AS_OF, RULES, order="made")
    return _outbox(posted.posted_reports(spark, path))


SQL["posted_weekly_report"] = SQL["weekly_report"]


@query("SELECT DISTINCT acm_id, TIMESTAMP '1998-01-15' AS last_shown FROM w_listed WHERE overall <= 30")
def shown_by_posted_report(spark: SparkSession, sf: str) -> DataFrame:
    """Whom a published report leaves in the log."""
    log, path = _shifted(b.shown_log(spark, sf), "last_shown"), new_path(spark, "posted")
    targets = weekly.weekly_targets(b.upsell_tables(spark, sf), AS_OF, RULES, shown_log=log)
    posted.post_weekly_report(spark, path, "posted", targets, _upsell_copy(spark, sf), AS_OF, RULES, order="made")
    return posted.shown_log(spark, path)


def _upsell_ids(spark: SparkSession, sf: str) -> DataFrame:
    return _approved(spark, sf).filter((F.col("workflow") == "weekly_upsell") & ~F.col("test_mode"))


def _weekly_mail(spark: SparkSession, sf: str) -> DataFrame:
    t = b.upsell_tables(spark, sf)
    log = _shifted(b.sent_log(spark, sf, t.users), "last_sent")
    targets = weekly.weekly_targets(t, AS_OF, RULES)
    return weekly.weekly_mailing(targets, _upsell_copy(spark, sf), log, o.UPSELL_TEMPLATE, AS_OF, ids=_upsell_ids(spark, sf), order="made")


def _weekly_mail_all(spark: SparkSession, sf: str) -> DataFrame:
    """Every approved accommodation that is a target, whatever its place in a report."""
    t, ids = b.upsell_tables(spark, sf), _upsell_ids(spark, sf)
    log = _shifted(b.sent_log(spark, sf, t.users), "last_sent")
    targets = weekly.weekly_targets(t, AS_OF, RULES, no_ad_limit=None, upgrade_limit=None, ids=ids)
    return weekly.weekly_mailing(targets, _upsell_copy(spark, sf), log, o.UPSELL_TEMPLATE, AS_OF, ids=ids, order="made", limited=False)


def _mailed_sql(source: str, days: int, html: str, recipient: str = "coalesce(host_email, '')", subject: str = "subject") -> str:
    return (
        f"SELECT acm_id, {recipient} AS recipient, {subject} AS subject, outcome, CASE WHEN outcome = 'skip' THEN "
        f"coalesce(strftime(last_sent + INTERVAL {days} DAY, '%Y-%m-%d'), '알 수 없음') ELSE '' END AS next_available, "
        f"CASE WHEN outcome = 'success' THEN {html} ELSE '' END AS html FROM {source}"
    )


def _mailed(mailed: DataFrame) -> DataFrame:
    return _no_nulls(mailed.select("acm_id", "recipient", "subject", "outcome", "next_available", "html"))


@query(_mailed_sql("w_mail", 14, o.UPSELL_HTML))
def weekly_mailing(spark: SparkSession, sf: str) -> DataFrame:
    return _mailed(_weekly_mail(spark, sf))


@query(_mailed_sql("w_mail_all", 14, o.UPSELL_HTML))
def weekly_mailing_all(spark: SparkSession, sf: str) -> DataFrame:
    return _mailed(_weekly_mail_all(spark, sf))


@query(
    _report_sql("monthly_report", "card", f"{M_CARDS} WHERE pos <= 20", o.REPORT_CARD)
    + " UNION ALL " + _report_sql("monthly_report", "review", f"{M_CARDS} WHERE has_copy", o.review("report"))
    + " UNION ALL " + _report_sql("monthly_report", "direct_call", f"{M_CARDS} WHERE consecutive_zero", o.DIRECT_CALL)
    + " UNION ALL " + _single_sql("monthly_report", "title", "(SELECT 1)", "'Advertised stays, 1998-01-15'")
    + " UNION ALL " + _single_sql("monthly_report", "header", "m_scored", o.REPORT_HEADER)
    + " UNION ALL " + _single_sql("monthly_report", "summary", "m_scored", o.REPORT_SUMMARY)
    + " UNION ALL " + _single_sql("monthly_report", "direct_call_heading", "m_scored WHERE consecutive_zero HAVING count(*) > 0", "'To call: ' || count(*)")
    + " UNION ALL " + _single_sql("monthly_report", "footer", "m_scored HAVING count(*) > 20", "(count(*) - 20) || ' more in the previews'")
    + " UNION ALL " + _bulk_sql("monthly_report", f"{M_CARDS} WHERE has_copy", "pos")
)
def monthly_report(spark: SparkSession, sf: str) -> DataFrame:
    return _outbox(monthly.monthly_report(_limited_hosts(spark, sf), _monthly_copy(spark, sf), AS_OF, order="made"))


def _monthly_mail(spark: SparkSession, sf: str, test_to: str, limit: int | None) -> DataFrame:
    t = b.monthly_tables(spark, sf)
    ids = _approved(spark, sf).filter(F.col("workflow") == "monthly_report")
    log = _shifted(b.sent_log(spark, sf, t.users), "last_sent")
    hosts = monthly.monthly_hosts(t, AS_OF, RULES, limit=limit, ids=None if limit else ids)
    return _mailed(monthly.monthly_mailing(hosts, _monthly_copy(spark, sf), log, o.REPORT_TEMPLATE, ids, AS_OF, test_to=test_to, order="made"))


@query(_mailed_sql("m_mail", 25, o.REPORT_HTML, "'review@example.com'", "'[테스트] ' || subject"))
def monthly_mailing(spark: SparkSession, sf: str) -> DataFrame:
    """The approved hosts of the report, mailed to the reviewer."""
    return _monthly_mail(spark, sf, "review@example.com", 200)


@query(_mailed_sql("m_mail_all", 25, o.REPORT_HTML))
def monthly_mailing_all(spark: SparkSession, sf: str) -> DataFrame:
    """Every approved host, whatever its place in the report, mailed for real."""
    return _monthly_mail(spark, sf, "", None)


# --- sources and sinks -----------------------------------------------------------------------------


@query(
    "SELECT name, CAST(n AS BIGINT) AS records FROM (SELECT 'accommodations' AS name, count(*) AS n FROM u_acm UNION ALL SELECT 'users', count(*) FROM u_user "
    "UNION ALL SELECT 'rooms', count(*) FROM orders UNION ALL SELECT 'reservations', count(*) FROM u_res UNION ALL SELECT 'accommodation_adverts', count(*) FROM orders "
    f"UNION ALL SELECT 'user_infos', sum(len({o.phones_of('c_custkey')})) FROM customer WHERE c_custkey % 13 <> 5 "
    "UNION ALL SELECT 'accommodation_types', count(DISTINCT type_name) FROM u_acm)"
)
def tables_loaded(spark: SparkSession, sf: str) -> DataFrame:
    """The tables written as files and loaded again."""
    path, native = new_path(spark, "tables"), b.upsell_tables(spark, sf)
    for name, schema in NATIVE.items():
        getattr(native, name).select([F.col(f.name).cast(f.dataType) for f in schema]).write.parquet(f"{path}/{name}")
    loaded = vars(load_tables(spark, path))
    counts = [df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("name"), "records") for name, df in loaded.items()]
    return reduce(DataFrame.unionByName, counts)


@query("SELECT acm_id, last_shown FROM e_shown")
def contact_log_import(spark: SparkSession, sf: str) -> DataFrame:
    """The shown log in its JSON form, with stamps at UTC, read back."""
    path = new_path(spark, "log")
    stamp = F.date_format(F.col("last_shown") - F.expr("INTERVAL 9 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    entry = F.concat(F.to_json(F.array(F.col("acm_id").cast("string"))), F.lit(": "), F.to_json(F.array(stamp)))
    entries = b.shown_log(spark, sf).select("acm_id", F.translate(entry, "[]", "").alias("value"))
    # One object, written line by line: its opening, all entries but one, the last one and the end.
    last = entries.agg(F.max(F.struct("acm_id", "value")).alias("e")).select("e.*")
    opening = spark.range(1).select(F.lit(0).alias("part"), F.lit('{"acms": {').alias("value"))
    others = entries.join(last.select("acm_id"), "acm_id", "left_anti").select(F.lit(1).alias("part"), F.concat("value", F.lit(",")).alias("value"))
    ending = last.select(F.lit(2).alias("part"), F.concat(F.coalesce("value", F.lit("")), F.lit("}}")).alias("value"))
    opening.unionByName(others).unionByName(ending).coalesce(1).sortWithinPartitions("part").select("value").write.text(path)
    return read_contact_log(spark, path, "acms", "acm_id", "last_shown", T.LongType())


@query(f"SELECT t.acm_id, {o.UPSELL_HTML} AS html FROM u_all t JOIN u_copy c ON c.acm_id = t.acm_id".replace("acm_id::VARCHAR", "t.acm_id::VARCHAR"))
def render_from_file(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "template")
    spark.range(1).select(F.lit(o.UPSELL_TEMPLATE)).write.option("lineSep", "\x00").text(path)
    template = load_template(spark, path).select(F.regexp_replace("value", "\x00", "").alias("value"))
    mails = with_copy(_all_targets(spark, sf), _upsell_copy(spark, sf), required=True, order="made")
    return render.render_upsell(mails, template).select("acm_id", "html")


@query(_report_sql("weekly_upsell", "review", U_ALL_COPY, o.review("offer")))
def outbox_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Previews of all targets, positions left out, through the outbox and back."""
    path = new_path(spark, "outbox")
    copied = with_copy(_all_targets(spark, sf), _upsell_copy(spark, sf), required=True, order="made")
    messages = copied.select("list_no", "acm_id", "subject", F.col("host_email").alias("recipient"), F.lit("review").alias("kind"), cards.review_text("offer").alias("body"))
    write_outbox(as_outbox(messages, AS_OF, "weekly_upsell"), path)
    return _outbox(read_outbox(spark, path))


SQL["outbox_round_trip"] = SQL["outbox_round_trip"].replace("list_no, pos, acm_id", "list_no, 0 AS pos, acm_id")


@query("SELECT click_id, CAST(epoch(requested) AS BIGINT)::VARCHAR AS request_ts, arrived_at FROM k_click")
def clicks_from_files(spark: SparkSession, sf: str) -> DataFrame:
    """Requests landed as JSON lines, read as a stream into a table."""
    path = new_path(spark, "landed")
    landed = _clicks(spark, sf).withColumn("arrived_at", F.date_format("arrived_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    landed.write.json(path)
    clicks.start_deliveries(clicks.read_clicks(spark, path), f"{path}-kept", f"{path}-state").awaitTermination()
    return spark.read.parquet(f"{path}-kept").select("click_id", "request_ts", "arrived_at")


# --- streams ---------------------------------------------------------------------------------------


def _stream_contacts(spark: SparkSession, sf: str) -> DataFrame:
    events = b.event_stream(spark, sf).filter(F.col("event_type") == "click")
    return events.select(F.col("user_id").alias("acm_id"), F.col("ts").alias("contacted_at"), "event_id")


@query("SELECT acm_id, last_shown FROM e_shown")
def contact_state_stream(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "contacts")
    stream = _stream_contacts(spark, sf).withColumnRenamed("contacted_at", "last_shown")
    contacts.start_contact_state(stream, "acm_id", "last_shown", path, f"{path}-state").awaitTermination()
    return read_contacts(spark, path, "acm_id", "last_shown", stream.schema["acm_id"].dataType)


def _gate_sql(source: str, keys: str, stamp: str, ident: str, days: str, columns: str) -> str:
    """Follow, from each key's first contact, the link to the next one that is due."""
    on = " AND ".join(f"a.{k.strip()} = n.{k.strip()}" for k in keys.split(","))
    link = " AND ".join(f"l.{k.strip()} = p.{k.strip()}" for k in keys.split(","))
    return f"""
    , contact AS (SELECT {keys}, {stamp} AS stamp, min({ident}) AS ident, {days} AS gap FROM {source} GROUP BY ALL)
    , link AS (SELECT a.*, n.stamp AS next_stamp, n.ident AS next_ident FROM contact a ASOF LEFT JOIN contact n ON {on} AND a.stamp + to_days(a.gap) < n.stamp)
    , passed AS (
      SELECT * FROM link l WHERE NOT EXISTS (SELECT 1 FROM contact p WHERE {link} AND p.stamp < l.stamp)
      UNION ALL SELECT l.* FROM passed p JOIN link l ON {link} AND l.stamp = p.next_stamp)
    SELECT {columns} FROM passed"""


def _with_gate(final: str, anchor: str) -> str:
    """``compose`` over the source, then the recursive part appended to its list."""
    head = compose(anchor)
    return head[: head.rindex("\n")] + final


_GATE_SOURCE = "SELECT * FROM e_click_contact"
o.CTES["e_click_contact"] = "SELECT user_id AS acm_id, ts, event_id FROM events WHERE event_type = 'click'"


def _gated(spark: SparkSession, stream: DataFrame, gap: str) -> DataFrame:
    path, rows = new_path(spark, "gate"), stream.withColumn("gap_days", F.expr(gap))
    contacts.start_gate(rows, ["acm_id"], "contacted_at", "event_id", "gap_days", path, f"{path}-state").awaitTermination()
    return spark.read.parquet(path).select("acm_id", "contacted_at", "event_id")


@query()
def frequency_gate(spark: SparkSession, sf: str) -> DataFrame:
    return _gated(spark, _stream_contacts(spark, sf), "7")


def _judged(spark: SparkSession, sf: str, gap: str) -> DataFrame:
    rows = b.click_contacts(spark, sf).withColumn("gap_days", F.expr(gap))
    passed = contacts.frequency_gate_batch(rows, ["acm_id"], "contacted_at", "event_id", "gap_days")
    return passed.select("acm_id", "contacted_at", "event_id")


@query()
def frequency_gate_batch(spark: SparkSession, sf: str) -> DataFrame:
    return _judged(spark, sf, "7")


#: Keys with gaps of their own: most wait far longer than the shortest gap, which cuts the slices.
MIXED_GAPS = "CASE user_id % 4 WHEN 0 THEN 2 WHEN 1 THEN 5 ELSE 25 END"


@query()
def frequency_gate_mixed(spark: SparkSession, sf: str) -> DataFrame:
    return _judged(spark, sf, f"CAST({MIXED_GAPS.replace('user_id', 'acm_id')} AS INT)")


@query()
def frequency_gate_hot(spark: SparkSession, sf: str) -> DataFrame:
    """All events under their five types: every key is long, and followed by links."""
    rows = b.read(spark, sf, "events").select("event_type", F.col("ts").alias("contacted_at"), "event_id").withColumn("gap_days", F.lit(1))
    passed = contacts.frequency_gate_batch(rows, ["event_type"], "contacted_at", "event_id", "gap_days")
    return passed.select("event_type", "contacted_at", "event_id")


def _gated_clicks(gap: str) -> str:
    return _with_gate(_gate_sql("e_click_contact", "acm_id", "ts", "event_id", gap, "acm_id, stamp AS contacted_at, ident AS event_id"), _GATE_SOURCE)


SQL["frequency_gate_hot"] = _with_gate(
    _gate_sql("events", "event_type", "ts", "event_id", "1", "event_type, stamp AS contacted_at, ident AS event_id"), _GATE_SOURCE
)
SQL["frequency_gate"] = SQL["frequency_gate_batch"] = _gated_clicks("7")
SQL["frequency_gate_mixed"] = _gated_clicks(MIXED_GAPS.replace("user_id", "acm_id"))


@query("SELECT click_id, epoch(requested)::BIGINT::VARCHAR AS request_ts, arrived_at FROM k_click")
def click_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every request arrives a second time, a minute later."""
    first = b.as_clicks(b.event_stream(spark, sf))
    again = b.as_clicks(b.event_stream(spark, sf)).withColumn(
        "arrived_at", F.col("arrived_at") + F.make_dt_interval(mins=F.lit(1))
    )
    path = new_path(spark, "clicks")
    clicks.start_deliveries(first.unionByName(again), path, f"{path}-state", within_minutes=10).awaitTermination()
    return spark.read.parquet(path).select("click_id", "request_ts", "arrived_at")


@query()
def approval_stream(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "approvals")
    approvals.start_approvals(b.as_clicks(b.event_stream(spark, sf)), path, f"{path}-state").awaitTermination()
    return approvals.approvals_outbox(spark, path).select("run_date", "workflow", "kind", "acm_id")


SQL["approval_stream"] = _with_gate(
    _gate_sql(
        "(SELECT * FROM k_approved WHERE NOT test_mode)", "workflow, acm_id", "arrived_at", "click_id",
        "CASE workflow WHEN 'monthly_report' THEN 25 ELSE 14 END",
        "strftime(stamp, '%Y-%m-%d') AS run_date, workflow, 'approval' AS kind, acm_id",
    ),
    "SELECT * FROM k_approved",
)


@query(
    "SELECT event_id AS click_id, reason, CAST(CASE WHEN kind = 9 AND reason IS NOT NULL THEN 3 ELSE 1 END AS BIGINT) AS n FROM k_odd WHERE reason IS NOT NULL "
    "UNION ALL SELECT event_id, 'repeated', 2 FROM k_odd WHERE reason IS NULL AND kind = 9 "
    "UNION ALL SELECT event_id, 'unusable id', 1 FROM k_odd WHERE reason IS NULL AND kind = 5"
)
def click_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """What a stream of approvals turns away, by click and reason."""
    path, landed = new_path(spark, "approvals"), new_path(spark, "odd")
    b.odd_clicks(b.read(spark, sf, "events")).write.parquet(landed)
    stream = spark.readStream.schema(CLICK_REQUEST).parquet(landed)
    approvals.start_approvals(stream, path, f"{path}-state").awaitTermination()
    found = approvals.rejected(spark, path).filter("reason <> 'held back'")
    return found.groupBy("click_id", "reason").agg(F.sum("rows").alias("n"))


def _approved_sql(workflow: str, kind: str, source: str, html: str) -> str:
    test = kind == "test_mail"
    to, subject = ("'review@example.com'", "'[테스트] ' || subject") if test else ("coalesce(host_email, '')", "subject")
    body = f"CASE WHEN outcome = 'success' THEN {html} ELSE '' END"
    return f"SELECT '{workflow}' AS workflow, '{kind}' AS kind, acm_id, {to} AS recipient, {subject} AS subject, {body} AS body, outcome FROM {source}"


@query(" UNION ALL ".join([
    _approved_sql("weekly_upsell", "mail", "w_mail_all", o.UPSELL_HTML), _approved_sql("weekly_upsell", "test_mail", "w_mail_test", o.UPSELL_HTML),
    _approved_sql("monthly_report", "mail", "m_mail_real", o.REPORT_HTML), _approved_sql("monthly_report", "test_mail", "m_mail_test", o.REPORT_HTML),
]))
def approved_mailing(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks, real ones and tests of both workflows, through the stream, taken by one run, mailed and published."""
    path, outbox = new_path(spark, "approvals"), new_path(spark, "outbox")
    approvals.start_approvals(b.as_clicks(b.event_stream(spark, sf)), path, f"{path}-state").awaitTermination()
    t, m = b.upsell_tables(spark, sf), b.monthly_tables(spark, sf)
    logs = [_shifted(b.sent_log(spark, sf, users), "last_sent") for users in (t.users, m.users)]
    targets = weekly.weekly_targets(t, AS_OF, RULES, no_ad_limit=None, upgrade_limit=None)
    hosts = monthly.monthly_hosts(m, AS_OF, RULES, limit=None)

    def weekly_mails(ids: DataFrame, test: bool) -> DataFrame:
        to = "review@example.com" if test else ""
        return weekly.weekly_mailing(targets, _upsell_copy(spark, sf), logs[0], o.UPSELL_TEMPLATE, AS_OF, ids=ids, test_to=to, order="made", limited=False)

    def monthly_mails(ids: DataFrame, test: bool) -> DataFrame:
        to = "review@example.com" if test else ""
        return monthly.monthly_mailing(hosts, _monthly_copy(spark, sf), logs[1], o.REPORT_TEMPLATE, ids, AS_OF, test_to=to, order="made")

    mail_approved(spark, path, outbox, "first", AS_OF, {"weekly_upsell": weekly_mails, "monthly_report": monthly_mails})
    return _no_nulls(published_mails(spark, outbox).select("workflow", "kind", "acm_id", "recipient", "subject", "body", "outcome"))
