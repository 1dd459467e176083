"""Bookings as a maintained table of daily sums, from which the jobs' windows are put together.

A row holds what a room's bookings of one status amount to on one day, by day of creation and by day of confirmation. Days
are stated by runs; a day that changes later is stated again as a whole, and the last run that states it is in force. A
window is the sum of its whole stated days, plus what the bookings themselves say of the rest: the days it begins and ends
in, and days no run has stated. So a window is right from the first day, and reads fewer bookings with every stated one.

Runs are named so that later ones sort after earlier ones (``batch_name``), and published as a whole: a run that broke off
shows nothing and is repeated under its name.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylift.config import Rules, now_sql
from staylift.functions.prices import realised_price
from staylift.operators.bookings import months_per_accommodation, per_accommodation
from staylift.operators.filters import status_in
from staylift.sources.runs import publish, read_published

CREATED, CONFIRMED = "created_at", "success_at"
DAY = timedelta(days=1)
TICK = timedelta(microseconds=1)
FEW = 4

SUMS = T.StructType(
    [
        T.StructField("stamp", T.StringType()), T.StructField("day", T.DateType()), T.StructField("room_id", T.LongType()),
        T.StructField("status", T.IntegerType()), T.StructField("res", T.LongType()),
        T.StructField("gmv", T.LongType()), T.StructField("gmv_positive", T.LongType()),
    ]
)
STATED = T.StructType([T.StructField("day", T.DateType())])


@dataclass(frozen=True)
class Span:
    """Bookings whose ``stamp`` lies from ``start`` on and before ``end``."""

    stamp: str
    start: datetime
    end: datetime

    def first_whole(self) -> date:
        day = self.start.date()
        return day if self.start.time() == time.min else day + DAY

    def days(self) -> list[date]:
        """The days that lie in it as a whole."""
        first = self.first_whole()
        return [first + k * DAY for k in range((self.end.date() - first).days)]


@dataclass(frozen=True)
class Measure:
    """A sum over the bookings of a span with certain statuses: their number, or one of the two prices."""

    span: Span
    statuses: tuple[int, ...]
    value: str = "res"


def _midnight(day: date) -> datetime:
    return datetime.combine(day, time.min)


def _date_sql(day: date) -> str:
    return f"DATE'{day.isoformat()}'"


def _ranges(days: Iterable[date]) -> list[tuple[datetime, datetime]]:
    """Days as few half-open ranges of time."""
    out: list[tuple[datetime, datetime]] = []
    for day in sorted(days):
        start, end = _midnight(day), _midnight(day + DAY)
        if out and out[-1][1] == start:
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def _hull(ranges: list[tuple[datetime, datetime]]) -> list[tuple[datetime, datetime]]:
    """At most FEW ranges that hold the given ones: their smallest gaps are closed."""
    gaps = sorted((b[0] - a[1] for a, b in zip(ranges, ranges[1:], strict=False)), reverse=True)
    least = gaps[FEW - 1] if len(gaps) >= FEW else timedelta(0)
    out = ranges[:1]
    for a, b in ranges[1:]:
        if a - out[-1][1] > least:
            out.append((a, b))
        else:
            out[-1] = (out[-1][0], b)
    return out


def _ranges_sql(stamp: str, ranges: list[tuple[datetime, datetime]]) -> str:
    return " OR ".join(f"({stamp} >= {now_sql(a)} AND {stamp} < {now_sql(b)})" for a, b in ranges) or "false"


def _inside(stamp: str, ranges: list[tuple[datetime, datetime]]) -> Column:
    """Whether a moment lies in one of the ranges. Many are a range or few, which a scan can skip by, and a set of days;
    a condition for each would be more than the compiler of a stage takes."""
    if len(ranges) <= FEW:
        return F.expr(_ranges_sql(stamp, ranges))
    spans = [Span(stamp, a, b) for a, b in ranges]
    days = [day for s in spans for day in s.days()]
    edges = []
    for s in spans:
        first, last = _midnight(s.first_whole()), max(_midnight(s.first_whole()), _midnight(s.end.date()))
        edges += [(a, b) for a, b in ((s.start, min(first, s.end)), (last, s.end)) if a < b]
    exact = f"to_date({stamp}) IN ({', '.join(map(_date_sql, days))})" if days else "false"
    return F.expr(f"({_ranges_sql(stamp, _hull(ranges))}) AND ({exact} OR {_ranges_sql(stamp, edges)})")


# --- stating days -------------------------------------------------------------------------------------


def changed_days(changes: DataFrame) -> list[date]:
    """The days that changed bookings count on. ``changes`` has them as they were and as they are: a booking that moved
    from one day to another changes both. The answer is no longer than the calendar."""
    days = changes.select(F.explode(F.array(F.to_date(CREATED), F.to_date(CONFIRMED))).alias("day"))
    return sorted(r.day for r in days.filter("day IS NOT NULL").distinct().collect())


def daily_sums(reservations: DataFrame, days: Iterable[date]) -> DataFrame:
    """The sums of the given days, from one scan that skips what lies outside them. Equal days are summed map-side, so that
    a hot room is a row per task."""
    ranges = _ranges(set(days))
    stamped = F.explode(F.array(*[F.struct(F.lit(s).alias("stamp"), F.col(s).alias("at")) for s in (CREATED, CONFIRMED)]))
    kept = reservations.filter(_inside(CREATED, ranges) | _inside(CONFIRMED, ranges))
    rows = kept.select(
        "room_id", F.col("status").cast("int").alias("status"), stamped.alias("s"),
        realised_price(positive_only=False).alias("gmv"), realised_price(positive_only=True).alias("gmv_positive"),
    ).filter(_inside("s.at", ranges))
    sums = rows.groupBy(F.col("s.stamp").alias("stamp"), F.to_date("s.at").alias("day"), "room_id", "status").agg(
        F.count(F.lit(1)).alias("res"), *[F.coalesce(F.sum(v), F.lit(0)).alias(v) for v in ("gmv", "gmv_positive")]
    )
    return sums.select(*SUMS.names)


def state_days(reservations: DataFrame, path: str, run: str, days: Iterable[date]) -> bool:
    """State ``days`` anew as of these bookings, days without bookings too. False if the run is published already."""
    spark, days = reservations.sparkSession, sorted(set(days))
    # A day's rows lie together and by room, so that a reader of few days skips the other row groups.
    sums = daily_sums(reservations, days).repartitionByRange("day", "room_id").sortWithinPartitions("day", "room_id")
    return publish(spark, path, run, sums=sums, stated=spark.createDataFrame([(d,) for d in days], STATED).coalesce(1))


def stated_days(spark: SparkSession, path: str, first: date, last: date) -> dict[date, str]:
    """The days from ``first`` to ``last`` that are stated, with the run in force: no more than these days."""
    rows = read_published(spark, path, "stated", STATED).filter(F.col("day").between(F.lit(first), F.lit(last)))
    return {r.day: r.run for r in rows.groupBy("day").agg(F.max("run").alias("run")).collect()}


# --- windows ------------------------------------------------------------------------------------------


def _wide(rows: DataFrame, measures: dict[str, Measure], inside: dict[Span, Column]) -> DataFrame:
    """A row's share of every measure; rows that are in no measure's count or value go."""
    part = {n: inside[m.span] & status_in(m.statuses) for n, m in measures.items()}
    any_part = F.lit(False)
    for condition in part.values():
        any_part = any_part | condition
    shares = [F.coalesce(F.when(part[n], F.col(m.value)), F.lit(0)).alias(n) for n, m in measures.items()]
    return rows.filter(any_part).select("room_id", *shares)


def window_shares(reservations: DataFrame, path: str, measures: dict[str, Measure]) -> DataFrame:
    """room_id and a column per measure, to be summed: a row per room, status and stated day, or per booking of the rest."""
    spark, spans = reservations.sparkSession, sorted({m.span for m in measures.values()}, key=lambda s: (s.stamp, s.start, s.end))
    wanted = {day for s in spans for day in s.days()}
    stated = stated_days(spark, path, min(wanted), max(wanted)) if wanted else {}
    stated = {day: run for day, run in stated.items() if day in wanted}

    # What a span leaves to the bookings: everything in it but its whole stated days.
    rest: dict[Span, list[tuple[datetime, datetime]]] = {}
    for s in spans:
        rest[s], at = [], s.start
        for a, b in [*_ranges(d for d in s.days() if d in stated), (s.end, s.end)]:
            if at < a:
                rest[s].append((at, a))
            at = b
    raw_inside = {s: _inside(s.stamp, rest[s]) for s in spans}
    read = F.lit(False)
    for condition in raw_inside.values():
        read = read | condition
    bookings = reservations.filter(read).select(
        "room_id", "status", CREATED, CONFIRMED, F.lit(1).cast("long").alias("res"),
        realised_price(positive_only=False).alias("gmv"), realised_price(positive_only=True).alias("gmv_positive"),
    )
    raw = _wide(bookings, measures, raw_inside)
    if not stated:
        return raw

    by_run: dict[str, list[date]] = {}
    for day, run in stated.items():
        by_run.setdefault(run, []).append(day)
    in_force = F.lit(False)
    for run, days in by_run.items():
        in_force = in_force | ((F.col("run") == run) & F.expr(f"day IN ({', '.join(map(_date_sql, sorted(days)))})"))
    sums = spark.read.schema(T.StructType([*SUMS, T.StructField("run", T.StringType())])).parquet(f"{path}/sums").filter(in_force)
    whole = {
        s: (F.col("stamp") == s.stamp) & (F.col("day") >= F.lit(s.first_whole())) & (F.col("day") < F.lit(s.end.date())) for s in spans
    }
    return _wide(sums, measures, whole).unionByName(raw)


def _since(stamp: str, as_of: datetime, days: int) -> Span:
    return Span(stamp, as_of - timedelta(days=days), as_of + TICK)


def _month(as_of: datetime, months_ago: int) -> datetime:
    months = as_of.year * 12 + as_of.month - 1 - months_ago
    return datetime(months // 12, months % 12 + 1, 1)


def weekly_activity(reservations: DataFrame, rooms: DataFrame, path: str, as_of: datetime, rules: Rules) -> DataFrame:
    """What ``bookings.weekly_activity`` finds by a scan of its whole span, from the daily sums under ``path``."""
    booked, upgrade = _since(CREATED, as_of, rules.no_ad_days), _since(CONFIRMED, as_of, rules.upgrade_days)
    paid = tuple(s for s in rules.paid_statuses if s in rules.booked_statuses)
    measures = {
        "booked": Measure(booked, rules.booked_statuses),
        "confirmed": Measure(upgrade, rules.confirmed_statuses),
        "confirmed_gmv": Measure(upgrade, rules.confirmed_statuses, "gmv"),
        "baseline": Measure(_since(CONFIRMED, as_of, rules.baseline_days), rules.confirmed_statuses),
    }
    if paid:
        measures["booked_gmv"] = Measure(booked, paid, "gmv")
    shares = window_shares(reservations, path, measures)
    if not paid:
        shares = shares.withColumn("booked_gmv", F.lit(0).cast("long"))
    order = ["booked", "booked_gmv", "confirmed", "confirmed_gmv", "baseline"]
    return per_accommodation(shares, rooms, {name: F.sum(name) for name in order})


def monthly_activity(
    reservations: DataFrame, rooms: DataFrame, path: str, as_of: datetime, rules: Rules, *, fanout_compat: bool = False
) -> DataFrame:
    """What ``bookings.monthly_activity`` finds by a scan of two months, from the daily sums under ``path``."""
    measures = {}
    for name, ago in (("this", 1), ("last", 2)):
        span = Span(CONFIRMED, _month(as_of, ago), _month(as_of, ago - 1))
        measures[f"res_{name}_month"] = Measure(span, rules.confirmed_statuses)
        measures[f"gmv_{name}_month"] = Measure(span, rules.confirmed_statuses, "gmv_positive")
    shares = window_shares(reservations, path, measures)
    per_room = shares.groupBy("room_id").agg(*[F.sum(name).alias(name) for name in measures])
    return months_per_accommodation(per_room, rooms, fanout_compat=fanout_compat)
