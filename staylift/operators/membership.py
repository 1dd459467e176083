"""Bloom filters: a test, inside the row, whether a key can be in a table.

For rows of which few have a partner: those without are told apart in the scan, before anything is exploded, shuffled or
sorted. A filter has as many bits as its maker says, however many keys there are; beyond what the bits are good for it lets
more rows through, never fewer.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylift.operators.numbering import checkpointed

WORD = 64
MOST_BITS = 1 << 23


def _places(key: Column, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(k), key), F.lit(bits)) for k in range(hashes)]


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (place % WORD).cast("int"))


@dataclass(frozen=True)
class Bloom:
    """A filter of ``bits`` bits as one row with an array of longs."""

    stored: DataFrame
    bits: int
    hashes: int

    def words(self) -> Column:
        """The filter as a scalar subquery."""
        return self.stored.scalar()

    def may_hold(self, key: Column, words: Column | None = None) -> Column:
        """False only for keys that were not given; ``words`` is the filter where it is a column already (inside a lambda)."""
        words = self.words() if words is None else words
        found = F.lit(True)
        for place in _places(key, self.bits, self.hashes):
            found = found & (F.get(words, F.floor(place / WORD).cast("int")).bitwiseAND(_bit(place)) != 0)
        return found


def bloom(keys: DataFrame, key: str, bits: int | None = None, hashes: int = 2, *, keep: bool = True) -> Bloom:
    """The filter of a column's values. Its bits are gathered map-side, so that one task sees ``bits`` / 64 longs at most.

    ``bits`` are a power of two, 64 at least; None asks for 16 a key, MOST_BITS (1 MB) at most. With ``keep`` the filter is
    computed now and stored, for use in several places; without, by the query that uses it.
    """
    if bits is None:
        keys = checkpointed(keys.select(key))
        bits = min(MOST_BITS, 1 << max(12, (16 * keys.count() - 1).bit_length()))
    place = F.explode(F.array(*_places(F.col(key), bits, hashes))).alias("place")
    words = keys.select(place).groupBy(F.floor(F.col("place") / WORD).alias("word")).agg(F.bit_or(_bit(F.col("place"))).alias("mask"))
    every = keys.sparkSession.range(bits // WORD).join(words, F.col("id") == F.col("word"), "left").select("id", F.coalesce("mask", F.lit(0).cast("long")).alias("mask"))
    stored = every.agg(F.sort_array(F.collect_list(F.struct("id", "mask"))).alias("all")).select(F.col("all.mask").alias("words"))
    return Bloom(checkpointed(stored) if keep else stored, bits, hashes)
