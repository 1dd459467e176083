"""The price a booking realised."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def realised_price(
    *, positive_only: bool, suggestion: str = "suggestion_price", total: str = "total_price", total_set: str = "total_price_set"
) -> Column:
    """Suggested price if set, else the list price when no set price exists, else the set price.

    The weekly job takes any non-zero suggestion, the monthly one only positive suggestions.
    Whole currency units as LONG, half away from zero. A NULL set price yields NULL, which sums ignore.
    """
    usable = ">" if positive_only else "<>"
    return F.expr(
        f"""CAST(round(CASE WHEN {suggestion} {usable} 0 THEN {suggestion}
                            WHEN {total_set} = 0 THEN {total}
                            ELSE {total_set} END, 0) AS LONG)"""
    )
