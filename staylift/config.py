"""Business parameters. Everything a deployment may want to change lives here."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Packages:
    """Names of the advert tiers and what each adds, in the caller's words; the rates 0.15 / 0.20 / 0.30 are fixed."""

    starter: str = "스타터 패키지"
    partner: str = "파트너 패키지"
    top: str = "프리미엄 패키지"
    starter_adds: str = "a place in the advertised list"
    partner_adds: str = "coupons of its own"
    top_adds: str = "a place on the first page"

    def ladder(self) -> list[tuple[str | None, str, float]]:
        """(current rate or None, next package, next rate). Rates not listed get no offer."""
        return [
            (None, self.starter, 0.15),
            ("0.10", self.starter, 0.15),
            ("0.15", self.partner, 0.20),
            ("0.20", self.top, 0.30),
        ]

    def benefits(self) -> dict[str, str]:
        """What each tier brings: its own entry and those of the tiers below."""
        adds = [self.starter_adds, self.partner_adds, self.top_adds]
        return {name: "; ".join(adds[: n + 1]) for n, name in enumerate([self.starter, self.partner, self.top])}

    def upgrade_offers(self) -> list[tuple[str, str, str]]:
        """(current rate, offered package, what it adds) for growing hosts."""
        return [("0.15", self.partner, self.partner_adds), ("0.20", self.top, self.top_adds)]


@dataclass(frozen=True)
class Rules:
    """Who may be contacted, and which bookings count. Statuses, spans, rates and filter words are fixed values."""

    house_domain: str = "house.example"
    test_marker: str = "test"
    name_words: tuple[str, ...] = ("부산", "워케이션")
    type_suffix: str = "위탁"
    booked_statuses: tuple[int, ...] = (1, 3, 6, 7, 8, 12)
    paid_statuses: tuple[int, ...] = (7, 8, 12)
    confirmed_statuses: tuple[int, ...] = (7, 8)
    no_ad_days: int = 90
    upgrade_days: int = 180
    baseline_days: int = 90
    upgrade_max_rate: str = "0.15"
    report_min_rate: str = "0.15"
    sender_team: str = "사업운영팀"
    packages: Packages = field(default_factory=Packages)


def now_sql(as_of: datetime) -> str:
    return f"TIMESTAMP_NTZ'{as_of.isoformat(sep=' ')}'"


def at(as_of: datetime) -> Column:
    """The explicit "now": a wall-clock literal, independent of the session time zone."""
    return F.expr(now_sql(as_of))
