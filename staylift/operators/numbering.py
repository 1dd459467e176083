"""Positions and running sums over lists of any length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylift.sources.workspace import shared_folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Rows computed once and kept in the shared folder, so that later branches agree and a lost executor costs a read."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def running_total(rows: DataFrame, groups: list[str], order: list[Column | str], weight: Column, into: str) -> DataFrame:
    """Add ``into``: the sum of ``weight`` (long) over all rows of the same group that come earlier in ``order``.

    ``groups`` must hold no nulls; nulls in ``order`` come first; rows that tie are placed in any one order. The table
    is range-partitioned by group and order, so that a group of any size is cut into many partitions; each partition
    sums its own rows, and only the partitions' totals are summed across partitions. With a weight of one this is a
    gapless number. ``rows`` should be cheap to read twice (range bounds are sampled).
    """
    cut = checkpointed(
        rows.withColumn("_weight", weight.cast("long")).withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*groups, *order, "_tie").withColumn("_part", F.spark_partition_id())
    )
    before = (Window.unboundedPreceding, -1)
    parts = cut.groupBy("_part", *groups).agg(F.sum("_weight").alias("_total"))
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(*before)
    parts = parts.select("_part", *groups, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part", *groups).orderBy(*order, "_tie").rowsBetween(*before)
    summed = cut.withColumn("_inside", F.coalesce(F.sum("_weight").over(inside), F.lit(0)))
    return (
        summed.join(parts, ["_part", *groups])
        .withColumn(into, F.col("_before") + F.col("_inside"))
        .drop("_part", "_tie", "_weight", "_before", "_inside")
    )
