"""Rendered messages as a table; delivery reads it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OUTBOX = T.StructType(
    [
        T.StructField("run_date", T.StringType()),
        T.StructField("workflow", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("list_no", T.IntegerType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("acm_id", T.LongType()),
        T.StructField("recipient", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("outcome", T.StringType()),
    ]
)


def message_parts(**parts: tuple[Column, Column]) -> Column:
    """``kind=(condition, body)`` -> array of (kind, body) for the parts whose condition holds.

    Exploding it yields all messages of a target from one pass over the targets.
    """
    entries = [
        F.when(wanted, F.struct(F.lit(kind).alias("kind"), body.alias("body"))) for kind, (wanted, body) in parts.items()
    ]
    return F.array_compact(F.array(*entries))


def as_outbox(messages: DataFrame, as_of: datetime, workflow: str) -> DataFrame:
    """Bring messages to the outbox schema; columns they lack are NULL."""
    stamped = messages.withColumns({"run_date": F.lit(f"{as_of:%Y-%m-%d}"), "workflow": F.lit(workflow)})
    return stamped.select(
        *[(F.col(f.name) if f.name in stamped.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in OUTBOX]
    )


def write_outbox(messages: DataFrame, path: str) -> None:
    """One folder per run date and workflow. Re-running a day replaces that day only."""
    (
        messages.select(*OUTBOX.names)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date", "workflow")
        .parquet(path)
    )


def read_outbox(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OUTBOX).parquet(path).select(*OUTBOX.names)
