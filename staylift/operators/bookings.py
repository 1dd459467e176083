"""Booking counts and values per accommodation.

Bookings are summed per room before they meet the rooms table, and per accommodation after it. Both
sums combine map-side, so neither a hot room nor a hot accommodation travels row by row, and no join
sees raw bookings. ``reservations.id`` is a primary key, so a plain count is the distinct count.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylift.config import Rules
from staylift.functions.prices import realised_price
from staylift.operators.filters import between_months, in_month, since, status_in


def per_accommodation(bookings: DataFrame, rooms: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """``measures`` summed per room, then per accommodation."""
    per_room = bookings.groupBy("room_id").agg(*[m.alias(name) for name, m in measures.items()])
    owners = rooms.selectExpr("id AS room_id", "accommodation_id AS acm_id")
    return (
        per_room.join(owners, "room_id")
        .groupBy("acm_id")
        .agg(*[F.sum(name).alias(name) for name in measures])
    )


def _count(condition: Column) -> Column:
    return F.count_if(condition)


def _value(condition: Column, price: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, price)), F.lit(0))


def booked_in_window(reservations: DataFrame, rooms: DataFrame, as_of: datetime, rules: Rules) -> DataFrame:
    """Bookings of any counted status by creation time: ``res``, and ``gmv`` over the paid ones."""
    kept = reservations.filter(
        since("created_at", as_of, rules.no_ad_days) & status_in(rules.booked_statuses)
    )
    paid = status_in(rules.paid_statuses)
    return per_accommodation(
        kept, rooms, {"res": F.count(F.lit(1)), "gmv": _value(paid, realised_price(positive_only=False))}
    )


def confirmed_in_window(
    reservations: DataFrame, rooms: DataFrame, as_of: datetime, days: int, rules: Rules, *, with_value: bool = True
) -> DataFrame:
    """Confirmed bookings by confirmation time: ``res`` and, if asked for, ``gmv``."""
    kept = reservations.filter(
        since("success_at", as_of, days) & status_in(rules.confirmed_statuses)
    )
    measures = {"res": F.count(F.lit(1))}
    if with_value:
        measures["gmv"] = F.coalesce(F.sum(realised_price(positive_only=False)), F.lit(0))
    return per_accommodation(kept, rooms, measures)


def weekly_activity(reservations: DataFrame, rooms: DataFrame, as_of: datetime, rules: Rules) -> DataFrame:
    """All three windows of the weekly job from one scan of the bookings."""
    booked = status_in(rules.booked_statuses) & since("created_at", as_of, rules.no_ad_days)
    confirmed = status_in(rules.confirmed_statuses)
    upgrade = confirmed & since("success_at", as_of, rules.upgrade_days)
    baseline = confirmed & since("success_at", as_of, rules.baseline_days)
    price = realised_price(positive_only=False)
    # The windows' common span alone, first: it is what the scan can skip row groups by.
    span = max(rules.no_ad_days, rules.upgrade_days, rules.baseline_days)
    recent = since("created_at", as_of, span) | since("success_at", as_of, span)
    return per_accommodation(
        reservations.filter(recent).filter(booked | upgrade | baseline),
        rooms,
        {
            "booked": _count(booked),
            "booked_gmv": _value(booked & status_in(rules.paid_statuses), price),
            "confirmed": _count(upgrade),
            "confirmed_gmv": _value(upgrade, price),
            "baseline": _count(baseline),
        },
    )


def monthly_activity(
    reservations: DataFrame, rooms: DataFrame, as_of: datetime, rules: Rules, *, fanout_compat: bool = False
) -> DataFrame:
    """Confirmed bookings and value of the last full month ("this") and the one before ("last").

    One scan. ``fanout_compat`` reproduces sums over bookings joined to a room once per month: there
    each booking of one month counts once per booking of the other month on the same room. That equals
    the room's sum times the other month's count (at least one), so no pair is ever formed.
    """
    this, last = in_month("success_at", as_of, 1), in_month("success_at", as_of, 2)
    price = realised_price(positive_only=True)
    kept = reservations.filter(between_months("success_at", as_of, 2, 1) & status_in(rules.confirmed_statuses))
    per_room = kept.groupBy("room_id").agg(
        _count(this).alias("res_this_month"),
        _value(this, price).alias("gmv_this_month"),
        _count(last).alias("res_last_month"),
        _value(last, price).alias("gmv_last_month"),
    )
    return months_per_accommodation(per_room, rooms, fanout_compat=fanout_compat)


def months_per_accommodation(per_room: DataFrame, rooms: DataFrame, *, fanout_compat: bool) -> DataFrame:
    """Both months' sums per room as sums per accommodation."""
    gmv_this, gmv_last = "gmv_this_month", "gmv_last_month"
    if fanout_compat:
        gmv_this, gmv_last = f"{gmv_this} * greatest(res_last_month, 1)", f"{gmv_last} * greatest(res_this_month, 1)"
    owners = rooms.selectExpr("id AS room_id", "accommodation_id AS acm_id")
    return (
        per_room.join(owners, "room_id")
        .groupBy("acm_id")
        .agg(
            F.sum("res_this_month").alias("res_this_month"),
            F.sum(F.expr(gmv_this)).alias("gmv_this_month"),
            F.sum("res_last_month").alias("res_last_month"),
            F.sum(F.expr(gmv_last)).alias("gmv_last_month"),
        )
    )
