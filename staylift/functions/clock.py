"""Wall-clock values as numbers, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"


def wall_micros(wall: Column) -> Column:
    """Microseconds from 1970-01-01 00:00 on the same clock."""
    days = F.date_diff(F.to_date(wall), F.lit("1970-01-01").cast("date")).cast("long")
    minutes = (days * 24 + F.hour(wall)) * 60 + F.minute(wall)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), wall) * 1_000_000).cast("long")


def from_epoch_seconds(seconds: Column) -> Column:
    return F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
