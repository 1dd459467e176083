from __future__ import annotations

import sys
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from staylift import Rules, Tables  # noqa: E402
from staylift.schemas import NATIVE  # noqa: E402

AS_OF = datetime(2025, 6, 16, 10, 0)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "America/New_York")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def days_ago(n: float) -> datetime:
    return AS_OF - timedelta(days=n)


@dataclass
class World:
    """Hand-made native tables. Every ``add_*`` returns the new id."""

    rows: dict[str, list] = field(default_factory=lambda: {name: [] for name in NATIVE})
    next_id: int = 1

    def _id(self) -> int:
        self.next_id += 1
        return self.next_id

    def acm(self, name="[제주/펜션] 바다", email="host@example.com", *, phone="01012345678", type_name=None,
            deleted=None, test=False, host="호스트", sales=7) -> int:
        acm, user = self._id(), self._id()
        self.rows["users"].append((user, host, email))
        for number in [phone] if isinstance(phone, str) else phone or []:
            self.rows["user_infos"].append((user, number))
        type_id = None
        if type_name is not None:
            type_id = self._id()
            self.rows["accommodation_types"].append((type_id, type_name))
        self.rows["accommodations"].append((acm, name, sales, user, type_id, deleted, test))
        self.rows["rooms"].append((acm * 1000, acm))
        return acm

    def room(self, acm: int) -> int:
        room = acm * 1000 + self._id()
        self.rows["rooms"].append((room, acm))
        return room

    def book(self, acm: int, n=1, *, status=7, when=None, created=None, suggested=None, total="100", total_set="0", room=None):
        when = when or days_ago(10)
        for _ in range(n):
            self.rows["reservations"].append(
                (self._id(), room or acm * 1000, status, created or when, when, *[None if p is None else Decimal(p) for p in (suggested, total, total_set)])
            )

    def advert(self, acm: int, rate: str, *, name="스타터 패키지", started=None, expires=None, paid=True):
        started = (started or days_ago(30)) if paid else None
        self.rows["accommodation_adverts"].append((self._id(), acm, name, Decimal(rate), started, expires))

    def tables(self, spark) -> Tables:
        return Tables(**{name: spark.createDataFrame(rows, NATIVE[name]) for name, rows in self.rows.items()})


@pytest.fixture
def world():
    return World()


@pytest.fixture(scope="session")
def rules():
    return Rules()


def ids(df) -> list[int]:
    return sorted(r.acm_id for r in df.select("acm_id").collect())


def by_id(df) -> dict:
    return {r.acm_id: r for r in df.collect()}
