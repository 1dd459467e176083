"""Predicates and parts of accommodation names and host addresses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def region_of(name: Column) -> Column:
    """Text between the last ``[`` that precedes the first ``/`` and that ``/``."""
    return F.substring_index(F.substring_index(name, "/", 1), "[", -1)


def has_all_words(name: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda found, word: found & name.contains(word), words, F.lit(True))


def mentions(text: Column, part: str) -> Column:
    """Case-insensitive substring test; NULL stays NULL and so drops out of a negated filter."""
    return F.lower(text).contains(part.lower())
