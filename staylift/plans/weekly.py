"""The weekly upsell job: targets, report, mailing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylift.config import Rules
from staylift.operators import adverts, bookings, cards, cooldown, lists, prompts, render
from staylift.operators.baselines import region_baseline
from staylift.operators.copy import with_copy
from staylift.operators.filters import nonempty_regions, only_ids, with_recipient
from staylift.operators.hosts import eligible_accommodations, with_phones, with_users
from staylift.operators.scoring import score_targets, with_baseline
from staylift.sources.outbox import as_outbox, message_parts
from staylift.sources.tables import Tables
from staylift.sources.workspace import settle

WORKFLOW = "weekly_upsell"
NO_AD_LIMIT, UPGRADE_LIMIT = 200, 20
SHOWN_DAYS, SENT_DAYS = 7, 14

_HOST = ["acm_id", "acm_name", "sales_id"]
_CONTACT = ["host_name", "host_email", "host_phone"]
_MEASURES = ["res_90d", "gmv_90d", "region"]


def _listed(found: DataFrame, t: Tables, columns: list[str], limit: int | None, compat: bool, phones: bool) -> DataFrame:
    """Count, order, limit. Phones are looked up for what is left, unless they weigh on the figures (``compat``)."""
    if compat:
        found = with_phones(found, t, compat=True)
    else:
        found = found.withColumn("host_copies", F.lit(1))
    found = found.withColumns({"res_90d": F.col("res") * F.col("host_copies"), "gmv_90d": F.col("gmv") * F.col("host_copies")})
    top = lists.top_by(found.drop("res", "gmv", "host_copies"), "res_90d", limit)
    if not phones:
        return top.select(*[c for c in columns if c in top.columns], "user_id")
    return top.select(*columns) if compat else lists.top_by(with_phones(top, t).select(*columns), "res_90d", limit)


def no_ad_targets(
    t: Tables, as_of: datetime, rules: Rules, limit: int | None = NO_AD_LIMIT, *,
    activity: DataFrame | None = None, compat: bool = False, shown_log: DataFrame | None = None,
    ids: DataFrame | None = None, phones: bool = True,
) -> DataFrame:
    """Accommodations without a running advert that were booked lately, most booked first.

    ``activity`` (res, gmv) replaces the scan of the bookings. A ``shown_log`` takes recently shown
    accommodations out before the limit instead of after it; ``ids`` is an allow-list that comes before the limit.
    Without ``phones`` the rows carry ``user_id``, by which they can be looked up later.
    """
    if activity is None:
        activity = bookings.booked_in_window(t.reservations, t.rooms, as_of, rules)
    advertised = adverts.advertised_ids(adverts.active_adverts(t.accommodation_adverts, as_of))
    acm = eligible_accommodations(t, rules)
    if ids is not None:
        acm = only_ids(acm, ids)
    if shown_log is not None:
        acm = cooldown.not_recently_shown(acm, shown_log, as_of, SHOWN_DAYS)
    # Only booked accommodations qualify, so the join need not keep the others.
    booked = acm.join(advertised, "acm_id", "left_anti").join(activity.filter("res > 0"), "acm_id")
    return _listed(with_users(booked, t, rules, exclude_test=True), t, [*_HOST, *_CONTACT, *_MEASURES], limit, compat, phones)


def upgrade_targets(
    t: Tables, as_of: datetime, rules: Rules, limit: int | None = UPGRADE_LIMIT, *,
    activity: DataFrame | None = None, compat: bool = False, exclude_test: bool = False,
    shown_log: DataFrame | None = None, ids: DataFrame | None = None, phones: bool = True, tiers: DataFrame | None = None,
) -> DataFrame:
    """Accommodations on a low tier, with their best running advert of that tier; zero bookings stay.

    ``tiers`` replaces the look at the adverts: what ``advert_timeline.counting_on`` finds among low ones.
    """
    if activity is None:
        activity = bookings.confirmed_in_window(t.reservations, t.rooms, as_of, rules.upgrade_days, rules)
    if tiers is None:
        tiers = adverts.top_tier(adverts.commission_at_most(adverts.active_adverts(t.accommodation_adverts, as_of), rules.upgrade_max_rate))
    acm = eligible_accommodations(t, rules)
    if ids is not None:
        acm = only_ids(acm, ids)
    if shown_log is not None:
        acm = cooldown.not_recently_shown(acm, shown_log, as_of, SHOWN_DAYS)
    counted = acm.join(tiers, "acm_id").join(activity, "acm_id", "left").fillna(0, ["res", "gmv"])
    columns = [*_HOST, "advert_name", "advert_commission", *_CONTACT, *_MEASURES]
    return _listed(with_users(counted, t, rules, exclude_test=exclude_test), t, columns, limit, compat, phones)


def region_ad_baseline(
    t: Tables, as_of: datetime, regions: DataFrame, rules: Rules, *,
    match: str = "like", activity: DataFrame | None = None,
) -> DataFrame:
    """Mean confirmed bookings of the advertised accommodations of each region."""
    if activity is None:
        activity = bookings.confirmed_in_window(
            t.reservations, t.rooms, as_of, rules.baseline_days, rules, with_value=False
        )
    advertised = adverts.advertised_ids(adverts.active_adverts(t.accommodation_adverts, as_of))
    return region_baseline(t.accommodations, advertised, activity.select("acm_id", "res"), regions, match=match)


def weekly_targets(
    t: Tables, as_of: datetime, rules: Rules, *, no_ad_limit: int | None = NO_AD_LIMIT, upgrade_limit: int | None = UPGRADE_LIMIT,
    shown_log: DataFrame | None = None, limit_after_cooldown: bool = False, match: str = "like", ids: DataFrame | None = None,
    activity: DataFrame | None = None,
) -> DataFrame:
    """Both scored lists with positions and their region's figures.

    The bookings are scanned once for all three windows, and the result (a row per active accommodation) is stored, as is
    the scored list, which regions, phones and the caller read. With ``ids`` the limits apply to the allowed
    accommodations alone; a limit of None lists all. ``activity`` replaces the scan: what
    ``booking_days.weekly_activity`` puts together from daily sums.
    """
    limited = no_ad_limit is not None and upgrade_limit is not None
    activity = settle(bookings.weekly_activity(t.reservations, t.rooms, as_of, rules) if activity is None else activity)
    common = {"shown_log": shown_log if limit_after_cooldown else None, "ids": ids, "phones": False}
    no_ad = no_ad_targets(
        t, as_of, rules, no_ad_limit, **common,
        activity=activity.select("acm_id", F.col("booked").alias("res"), F.col("booked_gmv").alias("gmv")),
    )
    upgrade = upgrade_targets(
        t, as_of, rules, upgrade_limit, **common,
        activity=activity.select("acm_id", F.col("confirmed").alias("res"), F.col("confirmed_gmv").alias("gmv")),
    )
    scored = lists.report_list(
        score_targets(no_ad, "no_ad", rules.packages), score_targets(upgrade, "upgrade", rules.packages), limited=limited
    )
    if shown_log is not None and not limit_after_cooldown:
        scored = lists.with_positions(cooldown.not_recently_shown(scored, shown_log, as_of, SHOWN_DAYS), limited=limited)
    targets = settle(scored)
    baseline = region_ad_baseline(
        t, as_of, nonempty_regions(targets), rules, match=match,
        activity=activity.select("acm_id", F.col("baseline").alias("res")),
    )
    return settle(with_baseline(with_phones(targets, t, listed=True).drop("user_id", "host_copies"), baseline))


def weekly_prompts(targets: DataFrame, rules: Rules, limit: int | None = lists.CANDIDATES) -> DataFrame:
    """What the copy generator is asked for: one prompt per candidate."""
    return prompts.upsell_prompts(lists.first_per_accommodation(lists.candidates(targets, limit)), rules)


def weekly_report(
    targets: DataFrame, copies: DataFrame, as_of: datetime, rules: Rules, *, order: str | None = None, limited: bool = True
) -> DataFrame:
    """Outbox rows of the review report: title, counts, headings, summary instruction, bulk ids, cards, mail previews.

    ``targets`` come from ``weekly_targets`` with the shown log; only candidates have copy.
    """
    listed = with_copy(lists.with_overall(targets, limited=limited), copies, required=False, order=order)
    has_copy = F.col("has_copy") & (F.col("overall") <= lists.CANDIDATES)
    listed = listed.withColumns({"has_copy": has_copy, "subject": F.when(has_copy, F.col("subject"))})
    carded = F.when(F.col("list_no") == 1, lists.NO_AD_CARDS).otherwise(lists.UPGRADE_CARDS) >= F.col("pos")
    messages = listed.withColumn(
        "part",
        F.explode(
            message_parts(
                card=(carded, cards.upsell_card_text()),
                review=(F.col("has_copy"), cards.review_text("offer")),
            )
        ),
    ).select("list_no", "pos", "acm_id", "subject", F.col("host_email").alias("recipient"), "part.kind", "part.body")
    approvable = lists.bulk_ids(targets.filter(F.col("grade").isin("A", "B")), ["list_no", "pos"], limited=limited)
    header = cards.upsell_header(targets)
    singles = (
        header.select(F.lit("title").alias("kind"), cards.title(cards.UPSELL_TITLE, as_of).alias("body"))
        .unionByName(header.select(F.lit("header").alias("kind"), F.col("header").alias("body")))
        .unionByName(prompts.upsell_summary_prompt(targets).select(F.lit("summary").alias("kind"), F.col("prompt").alias("body")))
    )
    headings = cards.upsell_headings(targets).select(F.lit("section").alias("kind"), "list_no", F.col("heading").alias("body"))
    bulk = approvable.select(F.lit("bulk").alias("kind"), F.col("part").alias("pos"), F.col("acm_ids").alias("body"))
    whole = messages.unionByName(singles, allowMissingColumns=True).unionByName(headings, allowMissingColumns=True)
    return as_outbox(whole.unionByName(bulk, allowMissingColumns=True), as_of, WORKFLOW)


def shown_contacts(targets: DataFrame, as_of: datetime) -> DataFrame:
    """Log rows to append after the report was posted."""
    return cooldown.mark_shown(lists.candidates(targets), as_of)


def approved_of(targets: DataFrame, ids: DataFrame, *, limited: bool = True) -> DataFrame:
    """The targets with an approved id; an approval without an id (a test click) asks for the first of the list."""
    ranked = lists.with_overall(targets, limited=limited)
    named = only_ids(ranked, ids.filter(F.col("acm_id").isNotNull()))
    unnamed = ids.filter(F.col("acm_id").isNull())
    first = ranked.filter((F.col("overall") <= lists.CANDIDATES) & unnamed.exists())
    return named.unionByName(first).dropDuplicates(["overall"])


def weekly_mailing(
    targets: DataFrame, copies: DataFrame, sent_log: DataFrame, template: DataFrame | str, as_of: datetime, *,
    ids: DataFrame | None = None, grades: tuple[str, ...] | None = None, test_to: str = "",
    dry_run: bool = False, one_per_host: bool = False, compat: bool = False, order: str | None = None, limited: bool = True,
) -> DataFrame:
    """Targets with copy, each with its outcome; mails that go out also have ``html``.

    With ``ids`` (approved clicks) all of them are candidates, otherwise the first of the list. For a mailing of every
    approved accommodation, whatever its place in a report, give the ids to ``weekly_targets`` too, with limits of None
    (and ``limited=False`` here). ``order`` says which of several copies of an id was made last.
    """
    if ids is not None:
        chosen = approved_of(targets, ids, limited=limited)
    else:
        chosen = lists.candidates(targets, grades=grades)
    if not compat:
        chosen = lists.first_per_accommodation(chosen)
    if one_per_host:
        chosen = lists.one_per_host(chosen, ["overall"])
    mailed = with_recipient(with_copy(chosen, copies, required=True, order=order), test_to)
    judged = cooldown.with_outcome(mailed, sent_log, as_of, SENT_DAYS, dry_run=dry_run)
    rendered = render.render_upsell(judged, template)
    return rendered.withColumn("html", F.when(F.col("outcome") == "success", F.col("html")))


def mailing_outbox(mailed: DataFrame, as_of: datetime, workflow: str = WORKFLOW) -> DataFrame:
    """A mailing as outbox rows: kind ``mail``, whatever their outcome, and for those held back ``notice`` and a heading."""
    mails = mailed.select(
        F.lit("mail").alias("kind"), "list_no", "pos", "acm_id", "recipient", "subject", F.col("html").alias("body"), "outcome"
    )
    skipped = mailed.filter((F.col("outcome") == "skip") & F.col("next_available").isNotNull())
    notices = cards.blocked_notices(skipped).select(F.lit("notice").alias("kind"), "list_no", "pos", "acm_id", F.col("notice").alias("body"))
    heading = cards.blocked_heading(skipped).select(F.lit("notice_heading").alias("kind"), F.col("heading").alias("body"))
    whole = mails.unionByName(notices, allowMissingColumns=True).unionByName(heading, allowMissingColumns=True)
    return as_outbox(whole, as_of, workflow)
