"""The monthly performance job: advertised hosts, report, mailing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylift.config import Rules
from staylift.functions.formats import month_label
from staylift.operators import adverts, bookings, cards, cooldown, lists, prompts, render
from staylift.operators.baselines import region_baseline
from staylift.operators.copy import with_copy
from staylift.operators.filters import month_start, nonempty_regions, only_ids, with_recipient
from staylift.operators.hosts import eligible_accommodations, with_phones, with_users
from staylift.operators.scoring import score_hosts
from staylift.sources.outbox import as_outbox, message_parts
from staylift.sources.tables import Tables
from staylift.sources.workspace import settle

WORKFLOW = "monthly_report"
HOST_LIMIT = 200
SENT_DAYS = 25

_MEASURES = ["res_this_month", "gmv_this_month", "res_last_month", "gmv_last_month"]
_COLUMNS = ["acm_id", "acm_name", "advert_name", "advert_commission", "host_name", "host_email", "host_phone", "region", *_MEASURES]


def report_month(as_of: datetime) -> Column:
    """Label of the month reported on, the last full one."""
    return month_label(month_start(as_of, 1))


def _qualifying(t: Tables, as_of: datetime, rules: Rules) -> DataFrame:
    return adverts.commission_at_least(adverts.active_adverts(t.accommodation_adverts, as_of), rules.report_min_rate)


def monthly_ad_hosts(
    t: Tables, as_of: datetime, rules: Rules, limit: int | None = HOST_LIMIT, *,
    activity: DataFrame | None = None, fanout_compat: bool = False, compat: bool = False,
    ids: DataFrame | None = None, phones: bool = True, latest: DataFrame | None = None,
) -> DataFrame:
    """Accommodations with a running advert of the reported tiers, and their last two full months.

    ``fanout_compat`` inflates the values as the two joins per room do; ``compat`` lets repeated phone
    records and identical adverts weigh on the values. ``ids`` is an allow-list that comes before the limit. Phones are
    looked up for what the limit leaves; without ``phones`` the rows carry ``user_id`` instead. ``latest`` replaces the
    look at the adverts: what ``advert_timeline.counting_on`` finds among those of the reported tiers.
    """
    if latest is None:
        latest = adverts.latest_advert(_qualifying(t, as_of, rules))
    if activity is None:
        activity = bookings.monthly_activity(t.reservations, t.rooms, as_of, rules, fanout_compat=fanout_compat)
    acm = eligible_accommodations(t, rules)
    if ids is not None:
        acm = only_ids(acm, ids)
    reported = acm.join(latest, "acm_id").join(activity, "acm_id", "left")
    found = with_users(reported, t, rules, exclude_test=True)
    weight = F.lit(1)
    if compat:
        found, weight = with_phones(found, t, compat=True), F.col("host_copies") * F.col("copies")
    found = found.withColumns(
        {m: F.coalesce(F.col(m) * (weight if m.startswith("gmv") else F.lit(1)), F.lit(0)) for m in _MEASURES}
    )
    top = lists.top_by(found.drop("copies", "host_copies", "success_at", "sales_id"), "res_this_month", limit)
    if not phones:
        return top.select(*[c for c in _COLUMNS if c in top.columns], "user_id")
    return top.select(*_COLUMNS) if compat else lists.top_by(with_phones(top, t).select(*_COLUMNS), "res_this_month", limit)


def region_month_baseline(
    t: Tables, as_of: datetime, regions: DataFrame, rules: Rules, *,
    match: str = "like", activity: DataFrame | None = None,
) -> DataFrame:
    """Mean bookings, and mean value per booking, of the advertised accommodations of each region."""
    if activity is None:
        activity = bookings.monthly_activity(t.reservations, t.rooms, as_of, rules)
    this_month = activity.select("acm_id", F.col("res_this_month").alias("res"), F.col("gmv_this_month").alias("gmv"))
    return region_baseline(t.accommodations, adverts.advertised_ids(_qualifying(t, as_of, rules)), this_month, regions, match=match)


def monthly_hosts(
    t: Tables, as_of: datetime, rules: Rules, *, limit: int | None = HOST_LIMIT, match: str = "like", ids: DataFrame | None = None,
    activity: DataFrame | None = None,
) -> DataFrame:
    """Scored hosts in report order (``pos``). Bookings are scanned once for hosts and baselines.

    What is stored: the month's activity, and the hosts, which regions, phones and the caller read. With ``ids`` the
    limit applies to the allowed accommodations alone; a limit of None lists all. ``activity`` replaces the scan: what
    ``booking_days.monthly_activity`` puts together from daily sums.
    """
    activity = settle(bookings.monthly_activity(t.reservations, t.rooms, as_of, rules) if activity is None else activity)
    found = monthly_ad_hosts(t, as_of, rules, limit, activity=activity, ids=ids, phones=False).withColumn("list_no", F.lit(1))
    order = [F.col("res_this_month").desc(), "acm_id", "advert_name"]
    hosts = settle(lists.numbered(found, ["list_no"], order, "pos", limited=limit is not None))
    baseline = region_month_baseline(t, as_of, nonempty_regions(hosts), rules, match=match, activity=activity)
    return settle(score_hosts(with_phones(hosts, t, listed=True).drop("user_id", "host_copies"), baseline))


def monthly_prompts(hosts: DataFrame, as_of: datetime, rules: Rules) -> DataFrame:
    return prompts.report_prompts(lists.first_per_accommodation(hosts), report_month(as_of), rules)


def monthly_report(
    hosts: DataFrame, copies: DataFrame, as_of: datetime, *, order: str | None = None, limited: bool = True
) -> DataFrame:
    """Outbox rows: title, counts, summary instruction, bulk ids, calls with their heading, cards, mail previews, footer."""
    listed = with_copy(hosts, copies, required=False, order=order)
    messages = listed.withColumn(
        "part",
        F.explode(
            message_parts(
                card=(F.col("pos") <= lists.MONTHLY_CARDS, cards.report_card_text()),
                review=(F.col("has_copy"), cards.review_text("report")),
                direct_call=(F.col("consecutive_zero"), cards.direct_call_line()),
            )
        ),
    ).select("list_no", "pos", "acm_id", "subject", F.col("host_email").alias("recipient"), "part.kind", "part.body")
    header = cards.report_header(hosts)
    singles = (
        header.select(F.lit("title").alias("kind"), cards.title(cards.REPORT_TITLE, as_of).alias("body"))
        .unionByName(header.select(F.lit("header").alias("kind"), F.col("header").alias("body")))
        .unionByName(prompts.report_summary_prompt(hosts, report_month(as_of)).select(F.lit("summary").alias("kind"), F.col("prompt").alias("body")))
        .unionByName(cards.direct_call_heading(hosts).select(F.lit("direct_call_heading").alias("kind"), F.col("heading").alias("body")))
        .unionByName(cards.report_footer(hosts).select(F.lit("footer").alias("kind"), F.col("footer").alias("body")))
    )
    approvable = lists.bulk_ids(listed.filter("has_copy"), ["pos"], limited=limited)
    bulk = approvable.select(F.lit("bulk").alias("kind"), F.col("part").alias("pos"), F.col("acm_ids").alias("body"))
    whole = messages.unionByName(singles, allowMissingColumns=True).unionByName(bulk, allowMissingColumns=True)
    return as_outbox(whole, as_of, WORKFLOW)


def monthly_mailing(
    hosts: DataFrame, copies: DataFrame, sent_log: DataFrame, template: DataFrame | str, ids: DataFrame,
    as_of: datetime, *, test_to: str = "", dry_run: bool = False, one_per_host: bool = False, compat: bool = False,
    order: str | None = None,
) -> DataFrame:
    """Approved hosts with copy, each with its outcome; mails that go out also have ``html``.

    An approval without an id (a test click) asks for the first of the report. For a mailing of every approved
    accommodation, whatever its place, give the ids to ``monthly_hosts`` too, with a limit of None.
    """
    named = only_ids(hosts, ids.filter(F.col("acm_id").isNotNull()))
    first = hosts.filter((F.col("pos") <= lists.CANDIDATES) & ids.filter(F.col("acm_id").isNull()).exists())
    chosen = named.unionByName(first).dropDuplicates(["pos"])
    if not compat:
        chosen = lists.first_per_accommodation(chosen)
    if one_per_host:
        chosen = lists.one_per_host(chosen, ["pos"])
    mailed = with_recipient(with_copy(chosen, copies, required=True, order=order), test_to)
    judged = cooldown.with_outcome(mailed, sent_log, as_of, SENT_DAYS, dry_run=dry_run)
    rendered = render.render_report(judged, template, report_month(as_of))
    return rendered.withColumn("html", F.when(F.col("outcome") == "success", F.col("html")))
