"""Runs published as a whole: tables written under a run's name, which readers see once the run is published."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylift.sources.contact_log import read_or_empty

RUN = T.StructField("run", T.StringType())


def published(spark: SparkSession, path: str) -> DataFrame:
    """The names of published runs."""
    return read_or_empty(spark, f"{path}/published", T.StructType([T.StructField("name", T.StringType()), RUN])).select("run")


def publish(spark: SparkSession, path: str, run: str, **tables: DataFrame) -> bool:
    """Write ``tables`` as ``<path>/<table>/run=<run>``, then publish the run by one file.

    Until that file is there readers see none of the run, after it all of it. A run that broke off is written again under
    the same name, over what it left. One that is published stays as it is: nothing is written, and the answer is False.
    """
    if not published(spark, path).filter(F.col("run") == run).isEmpty():
        return False
    for table, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{path}/{table}/run={run}")
    spark.createDataFrame([(run,)], "name STRING").coalesce(1).write.mode("overwrite").parquet(f"{path}/published/run={run}")
    return True


def read_published(spark: SparkSession, path: str, table: str, schema: T.StructType) -> DataFrame:
    """A table's rows of all published runs, with ``run``."""
    rows = read_or_empty(spark, f"{path}/{table}", T.StructType([*schema, RUN]))
    return rows.join(published(spark, path), "run", "left_semi").select(*schema.names, "run")
