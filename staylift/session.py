"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan at run time: merge small shuffle partitions, split skewed ones, switch to broadcasts that fit.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Database datetimes have no zone; Parquet files without one stay wall clock.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    # Streaming state outside the heap, for key sets larger than executor memory.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def tuned(builder: SparkSession.Builder, shuffle_partitions: int) -> SparkSession.Builder:
    """Apply the settings. ``shuffle_partitions`` is the upper number before run-time merging: take the
    shuffled bytes of the largest stage over 128 MB, at least two per core. ``spark.checkpoint.dir``
    must name a folder that every executor reaches; only a local session may leave it unset.
    """
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
