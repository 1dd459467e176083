"""Display formats used by cards, prompts and mails."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from staylift.functions.text import strip

# Symbols and labels of grades and performance classes.
GRADE_SYMBOLS = {"A": "🔴", "B": "🟠", "C": "🟡", "D": "⚪"}
PERF_SYMBOLS = {"growth": "🟢", "stable": "🟡", "poor": "🔴", "zero": "🔴", "new": "🔵"}
PERF_LABELS = {
    "growth": "성장 🟢", "stable": "유지 🟡", "poor": "저조 🔴", "zero": "예약 없음 🔴", "new": "첫 달 🔵",
}
NO_PHONE = "번호없음"


def lookup(key: Column, mapping: dict[str, str], default: str) -> Column:
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def thousands(amount: Column) -> Column:
    return F.format_number(amount.cast("long"), 0)


def one_decimal(value: Column) -> Column:
    return F.format_string("%.1f", F.round(value.cast("double"), 1))


def signed_percent(change: Column, *, plus_at_zero: bool) -> Column:
    """``+12.5%``; cards leave zero unsigned, prompts write ``+0.0%``."""
    plus = change >= 0 if plus_at_zero else change > 0
    return F.concat(F.when(plus, F.lit("+")).otherwise(F.lit("")), one_decimal(change), F.lit("%"))


def change_arrow(change: Column) -> Column:
    return (
        F.when(change > 0, F.concat(F.lit("▲ "), one_decimal(change), F.lit("%")))
        .when(change < 0, F.concat(F.lit("▼ "), one_decimal(F.abs(change)), F.lit("%")))
        .otherwise(F.lit("—"))
    )


def change_color(change: Column, up: str = "#1b6f4a", down: str = "#a8231c", level: str = "#5f5f5f") -> Column:
    return F.when(change > 0, up).when(change < 0, down).otherwise(level)


def rate_percent(rate: Column) -> Column:
    """0.15 -> 15, truncated, in DOUBLE arithmetic; no rate counts as 0."""
    return F.coalesce((rate.cast("double") * 100).cast("int"), F.lit(0))


def phone(number: Column) -> Column:
    """3-3-4 for ten digits, 3-4-4 for eleven, otherwise as given; empty becomes a label."""
    p = strip(number)
    size = F.length(p)
    return (
        F.when(number.isNull() | (number == ""), F.lit(NO_PHONE))
        .when(size == 10, F.concat_ws("-", p.substr(1, 3), p.substr(4, 3), p.substr(7, 4)))
        .when(size == 11, F.concat_ws("-", p.substr(1, 3), p.substr(4, 4), p.substr(8, 4)))
        .otherwise(p)
    )


def month_label(day: Column) -> Column:
    return F.date_format(day, "y'년' M'월'")
