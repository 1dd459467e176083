"""Which advert counts, for every moment at once: spans of time per accommodation, so that any past date is a lookup.

The moments at which an accommodation's adverts begin and end cut time into segments, numbered per accommodation. An
advert covers a run of numbers and is stored at the few nodes of a binary tree over them that make up the run; a segment
reads the nodes above it. So n adverts of one accommodation cost n log n rows, however many of them run side by side.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylift.config import at
from staylift.operators.numbering import running_total

#: Stands for the end of an advert that has none; adverts that end then or later count as having none.
OPEN = datetime(9999, 12, 31)


def _shift(number: str, level: str) -> str:
    return f"shiftright({number}, {level})"


def _tree_nodes(first: str, after: str) -> Column:
    """The nodes (level, node) of a binary tree over the numbers that make up first .. after - 1, two a level at most."""
    begin = f"shiftright({first} + shiftleft(1L, l) - 1, l)"
    left = f"IF({begin} < {_shift(after, 'l')} AND {begin} % 2 = 1, named_struct('level', l, 'node', {begin}), NULL)"
    right = f"IF({begin} < {_shift(after, 'l')} AND {_shift(after, 'l')} % 2 = 1, named_struct('level', l, 'node', {_shift(after, 'l')} - 1), NULL)"
    return F.expr(f"array_compact(flatten(transform(sequence(0, CAST(log2({after}) AS INT)), l -> array({left}, {right}))))")


def _segments(spans: DataFrame) -> DataFrame:
    """acm_id, moment, no (from 0, gapless), moments (of the accommodation)."""
    moments = spans.select("acm_id", F.explode(F.array("starts", "ends")).alias("moment")).distinct()
    numbered = running_total(moments, ["acm_id"], ["moment"], F.lit(1), "no")
    return numbered.join(numbered.groupBy("acm_id").agg(F.count("*").alias("moments")), "acm_id")


def _first(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The rows of a key with its largest ``order``, ties included; nulls come last."""
    best = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return rows.withColumn("_rank", F.rank().over(best)).filter("_rank = 1").drop("_rank")


def _timeline(adverts: DataFrame, what: list[str], order: str, *, copies: bool) -> DataFrame:
    found = adverts.filter("accommodation_id IS NOT NULL AND success_at IS NOT NULL").withColumns(
        {"acm_id": F.col("accommodation_id"), "starts": F.col("success_at"), "ends": F.least(F.coalesce("expiration_at", at(OPEN)), at(OPEN))}
    )
    spans = found.filter("starts < ends").groupBy("acm_id", *what, "starts", "ends").agg(F.count("*").alias("copies"))
    segments = _segments(spans)
    number = segments.select("acm_id", "moment", "no")
    numbered = (
        spans.join(number.select("acm_id", F.col("moment").alias("starts"), F.col("no").alias("first")), ["acm_id", "starts"])
        .join(number.select("acm_id", F.col("moment").alias("ends"), F.col("no").alias("after")), ["acm_id", "ends"])
    )
    nodes = numbered.select("acm_id", *what, "copies", F.inline(_tree_nodes("first", "after")))
    nodes = nodes.groupBy("acm_id", "level", "node", *what).agg(F.sum("copies").alias("copies"))
    nodes = _first(nodes, ["acm_id", "level", "node"], order)
    levels = F.expr("sequence(0, CAST(log2(moments) AS INT))")
    above = segments.select("acm_id", "no", F.explode(levels).alias("level")).withColumn("node", F.expr(_shift("no", "level")))
    counting = above.join(nodes, ["acm_id", "level", "node"]).groupBy("acm_id", "no", *what).agg(F.sum("copies").alias("copies"))
    counting = _first(counting, ["acm_id", "no"], order)
    shown = [*what, "copies"] if copies else what
    # Neighbouring segments with the same advert are one span: their numbers grow as their positions do.
    counting = counting.select("acm_id", "no", *shown, F.to_json(F.struct(*shown)).alias("_same"))
    placed = running_total(counting, ["acm_id", "_same"], ["no"], F.lit(1), "_place")
    merged = placed.groupBy("acm_id", *shown, (F.col("no") - F.col("_place")).alias("_island")).agg(F.min("no").alias("first"), (F.max("no") + 1).alias("after"))
    ends = F.when(F.col("ends") < at(OPEN), F.col("ends"))
    return (
        merged.join(number.select("acm_id", F.col("no").alias("first"), F.col("moment").alias("starts")), ["acm_id", "first"])
        .join(number.select("acm_id", F.col("no").alias("after"), F.col("moment").alias("ends")), ["acm_id", "after"])
        .select("acm_id", *shown, "starts", ends.alias("ends"))
    )


def best_timeline(adverts: DataFrame) -> DataFrame:
    """acm_id, advert_name, advert_commission, starts, ends (null: open): what ``top_tier`` of the running adverts gives
    for every moment from ``starts`` until before ``ends``.

    Adverts without accommodation or start never run; neither do those that end before they start. An empty table has no
    spans.
    """
    return _timeline(adverts, ["advert_name", "advert_commission"], "advert_commission", copies=False)


def latest_timeline(adverts: DataFrame) -> DataFrame:
    """The same for ``latest_advert``: with success_at, and copies, the number of identical rows that run."""
    return _timeline(adverts, ["advert_name", "advert_commission", "success_at"], "success_at", copies=True)


def counting_on(timeline: DataFrame, as_of: datetime) -> DataFrame:
    """The adverts that count at a moment, in the form of ``top_tier`` or ``latest_advert``."""
    return timeline.filter((F.col("starts") <= at(as_of)) & (F.col("ends").isNull() | (F.col("ends") > at(as_of)))).drop("starts", "ends")


def replayed(timeline: DataFrame, moments: Iterable[datetime]) -> DataFrame:
    """``counting_on`` for each of the listed moments, with ``as_of``, in one pass over the spans."""
    wanted = F.array(*[at(m) for m in sorted(set(moments))])
    inside = F.filter(wanted, lambda m: (F.col("starts") <= m) & (F.col("ends").isNull() | (F.col("ends") > m)))
    return timeline.withColumn("as_of", F.explode(inside)).drop("starts", "ends")
