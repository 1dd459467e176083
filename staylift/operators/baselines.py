"""What advertised accommodations of a region achieve on average."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylift.functions.names import region_of
from staylift.operators.filters import live_accommodations
from staylift.operators.membership import bloom

#: Size of the filter of region pieces: 4 kB, good for some thousand regions.
PIECE_BITS = 1 << 15


def _patterns(regions: DataFrame) -> DataFrame:
    """The part of each region to look up: its longest stretch free of ``%``.

    ``holes`` are the places of ``_`` in that stretch, where any character fits.
    """
    stretches = F.split("region", "%")
    longest = F.array_max(
        F.transform(stretches, lambda s: F.struct(F.length(F.replace(s, F.lit("_"), F.lit(""))).alias("n"), s.alias("s")))
    )["s"]
    return regions.select("region").distinct().select(
        "region",
        longest.alias("piece"),
        F.filter(F.sequence(F.lit(1), F.length(longest) + 1), lambda i: F.substring(longest, i, F.lit(1)) == "_").alias("holes"),
        F.contains(F.col("region"), F.lit("%")).alias("partial"),
    )


def _pieces_of(name: Column, shapes: Column) -> Column:
    """Every stretch of the name that has one of the shapes, with ``_`` written into the holes."""
    def stretches(shape: Column) -> Column:
        size = shape["size"]
        starts = F.when(F.length(name) >= size, F.sequence(F.lit(1), F.length(name) - size + 1)).otherwise(
            F.array().cast("array<int>")
        )
        def stretch(start: Column) -> Column:
            text = F.substring(name, start, size)
            masked = F.aggregate(shape["holes"], text, lambda t, hole: F.overlay(t, F.lit("_"), hole, F.lit(1)))
            return F.when(F.size(shape["holes"]) == 0, text).otherwise(masked)

        return F.transform(starts, stretch)

    return F.array_distinct(F.flatten(F.transform(shapes, stretches)))


def match_regions(named: DataFrame, regions: DataFrame, *, match: str = "like") -> DataFrame:
    """Pair each row (column ``acm_name``) with the regions it belongs to.

    ``like``: the name contains the region text, in which ``_`` and ``%`` are wildcards. Written as an
    equality join: a name is cut into its stretches of the lengths (and ``_`` places) that occur among
    the regions, and those are looked up. The work is linear in the names, not names times regions, and
    Spark sends the regions around while they are small.
    The shapes are as many as there are distinct region lengths, and come in as a scalar subquery. So does a Bloom filter of
    the regions' pieces, by which stretches that no region has are dropped inside the row: what is exploded and joined is
    little more than what matches.
    ``exact``: the name's own region equals the text.
    """
    if match == "exact":
        return named.withColumn("region", region_of(F.col("acm_name"))).join(regions.select("region").distinct(), "region")
    if match != "like":
        raise ValueError(f"match must be 'like' or 'exact', not {match!r}")
    patterns = _patterns(regions)
    shapes = patterns.agg(F.collect_set(F.struct(F.length("piece").alias("size"), "holes"))).scalar()
    known = bloom(patterns, "piece", PIECE_BITS, keep=False)
    shaped = named.withColumns({"shapes": shapes, "known": known.words()})
    likely = F.filter(_pieces_of(F.col("acm_name"), F.col("shapes")), lambda piece: known.may_hold(piece, F.col("known")))
    pieces = shaped.withColumn("piece", F.explode(likely)).drop("shapes", "known")
    keys = patterns.select("piece", "region", "partial")
    like = F.expr(r"acm_name LIKE concat('%', replace(region, '\\', '\\\\'), '%')")
    return pieces.join(keys, "piece").filter(~F.col("partial") | like).drop("piece", "partial")


def advertised_accommodations(accommodations: DataFrame, advertised: DataFrame) -> DataFrame:
    """acm_id and acm_name of live accommodations with a qualifying advert."""
    return (
        live_accommodations(accommodations)
        .select(F.col("id").alias("acm_id"), F.col("name_expression").alias("acm_name"))
        .join(advertised, "acm_id", "left_semi")
    )


def region_baseline(
    accommodations: DataFrame,
    advertised: DataFrame,
    activity: DataFrame,
    regions: DataFrame,
    *,
    match: str = "like",
) -> DataFrame:
    """region, avg_res, ad_acm_cnt; ``activity`` has ``res`` and, optionally, ``gmv`` per accommodation.

    With ``gmv`` also avg_price_per_res, the mean over accommodations that had bookings. Advertised
    accommodations without bookings count as zero; a region without any gets zeros.
    """
    with_value = "gmv" in activity.columns
    wanted = regions.select("region").distinct()
    measured = advertised_accommodations(accommodations, advertised).join(activity, "acm_id", "left").fillna(0)
    res = F.col("res")
    aggregates = [F.avg(res).alias("avg_res"), F.count(F.lit(1)).alias("ad_acm_cnt")]
    if with_value:
        aggregates.insert(1, F.avg(F.when(res > 0, F.col("gmv") / res)).alias("avg_price_per_res"))
    per_region = match_regions(measured, wanted, match=match).groupBy("region").agg(*aggregates)
    return wanted.join(per_region, "region", "left").fillna(0)
