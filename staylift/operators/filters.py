"""Row filters shared by the jobs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylift.config import now_sql
from staylift.functions.names import has_all_words, mentions
from staylift.functions.text import strip


def live_accommodations(accommodations: DataFrame) -> DataFrame:
    return accommodations.filter("deleted_at IS NULL AND NOT is_test")


def exclude_house_domain(df: DataFrame, email: str, domain: str) -> DataFrame:
    """A NULL address drops out too: a negated match on NULL is not true."""
    return df.filter(~mentions(F.col(email), domain))


def exclude_test_email(df: DataFrame, email: str, marker: str) -> DataFrame:
    return df.filter(~mentions(F.col(email), marker))


def exclude_name_all_of(df: DataFrame, name: str, words: tuple[str, ...]) -> DataFrame:
    """Drop names that contain every one of the words."""
    return df.filter(~has_all_words(F.col(name), words))


def exclude_type_suffix(df: DataFrame, types: DataFrame, suffix: str) -> DataFrame:
    """Drop rows whose ``type_id`` names a type (id, name) that ends in ``suffix``; a row without a type stays.

    Only the excluded types are looked up. Rows without a type get a key of their own each, so that they meet in no one
    task should the look-up be a shuffle.
    """
    excluded = types.filter(F.col("name").endswith(suffix)).select(F.col("id").cast("string").alias("type_key"))
    key = F.coalesce(F.col("type_id").cast("string"), F.concat(F.lit("none "), F.col("id").cast("string")))
    return df.withColumn("type_key", key).join(excluded, "type_key", "left_anti").drop("type_key")


def status_in(statuses: tuple[int, ...]) -> Column:
    return F.expr(f"status IN ({', '.join(map(str, statuses))})")


def since(column: str, as_of: datetime, days: int) -> Column:
    """Within ``days`` before the as-of moment, and not after it, so that past dates replay right."""
    now = now_sql(as_of)
    return F.expr(f"{column} BETWEEN {now} - INTERVAL '{days}' DAY AND {now}")


def month_start(as_of: datetime, months_ago: int) -> Column:
    """Midnight of the first day of the month that lies n months back."""
    return F.expr(_month_start_sql(as_of, months_ago))


def _month_start_sql(as_of: datetime, months_ago: int) -> str:
    return f"CAST(add_months(trunc({now_sql(as_of)}, 'month'), {-months_ago}) AS TIMESTAMP_NTZ)"


def month_range(as_of: datetime, months_ago: int) -> tuple[Column, Column]:
    """First and last day of the month that lies n months back."""
    first = month_start(as_of, months_ago).cast("date")
    return first, F.last_day(first)


def in_month(column: str, as_of: datetime, months_ago: int) -> Column:
    """Half-open on the timestamp itself, so file and row-group min/max can prune."""
    return between_months(column, as_of, months_ago, months_ago)


def between_months(column: str, as_of: datetime, first_ago: int, last_ago: int) -> Column:
    """From the start of the month ``first_ago`` months back to the end of the one ``last_ago`` back."""
    start, end = _month_start_sql(as_of, first_ago), _month_start_sql(as_of, last_ago - 1)
    return F.expr(f"{column} >= {start} AND {column} < {end}")


def only_ids(df: DataFrame, ids: DataFrame, key: str = "acm_id") -> DataFrame:
    """Allow-list."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def parse_ids(csv: Column) -> Column:
    """``"12, 7,,x"`` -> [12, 7]: trimmed, blanks and non-integers dropped, each id once."""
    parts = F.transform(F.split(csv, ","), lambda part: strip(part))
    return F.array_distinct(
        F.filter(F.transform(parts, lambda part: part.try_cast("bigint")), lambda number: number.isNotNull())
    )


def nonempty_regions(df: DataFrame) -> DataFrame:
    return df.filter(F.col("region") != "").select("region").distinct()


def with_recipient(df: DataFrame, test_to: str = "", subject: str = "subject") -> DataFrame:
    """Set ``recipient`` (NULL when there is none) and mark the subject of test mails."""
    recipient = F.lit(test_to) if test_to else F.when(F.col("host_email") != "", F.col("host_email"))
    marked = F.concat(F.lit("[테스트] "), F.col(subject)) if test_to else F.col(subject)
    return df.withColumns({"recipient": recipient.cast("string"), subject: marked})
