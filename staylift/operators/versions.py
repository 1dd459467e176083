"""Tables whose key repeats: rows landed more than once, and later versions of a row landed beside it.

Counts and sums take keys as unique. Where a landing zone cannot promise that, these come first: they say which keys
repeat, and leave one row of each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylift.operators.membership import bloom
from staylift.sources.tables import Tables

#: By which columns the last version of a row is told, where a table has such columns.
LAST_BY = {"reservations": ("success_at", "created_at"), "accommodation_adverts": ("success_at", "expiration_at")}


def repeated(rows: DataFrame, key: str = "id") -> DataFrame:
    """``key`` and ``copies`` (long) of the keys found more than once. Keys combine map-side; rows without a key are left out."""
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("copies")).filter("copies > 1")


def last_versions(rows: DataFrame, key: str = "id", order: Sequence[str] = ()) -> DataFrame:
    """One row per key, that of the largest ``order`` (nulls are smallest), ties by all columns in their order.

    The keys alone are counted first. A Bloom filter of those that repeat tells in the scan which rows can have a partner;
    the others are not shuffled. Versions of a key combine map-side, so one with a third of all rows is no hot task. Rows
    without a key cannot be told apart and all stay. Columns are compared, so none may be a map. This comes before any
    filter on a column that versions change, or an outdated version would stand in for one that was filtered out.
    """
    again = bloom(repeated(rows, key), key)
    unsure = F.coalesce(F.col(key).isNotNull() & again.may_hold(F.col(key)), F.lit(False))
    ranked = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)], F.struct(*rows.columns).alias("_row"))
    last = rows.filter(unsure).groupBy(F.col(key).alias("_key")).agg(F.max(ranked).alias("_last")).select("_last._row.*")
    return rows.filter(~unsure).unionByName(last)


def with_unique_ids(t: Tables, order: Mapping[str, Sequence[str]] = LAST_BY) -> Tables:
    """The tables with one row per id where ``order`` names them."""
    return replace(t, **{name: last_versions(getattr(t, name), "id", by) for name, by in order.items()})
