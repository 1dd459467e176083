"""Shared folder for intermediate tables and streaming state."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; unset and in local mode, one beside the warehouse's tables."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        sc.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch")
        current = sc.getCheckpointDir()
    return current


def new_path(spark: SparkSession, label: str) -> str:
    """A place for a table of this job: in its scratch folder inside ``scratch``, else in the shared folder."""
    return f"{(_scratch.get() or shared_folder(spark)).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate tables, whatever file system it is on."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """What a job settles inside goes to one folder, which is removed on leaving.

    Results must have been written elsewhere by then: ``with scratch(spark): write_outbox(...)``.
    """
    folder = new_path(spark, "job")
    token = _scratch.set(folder)
    try:
        yield folder
    finally:
        _scratch.reset(token)
        remove(spark, folder)


def settle(df: DataFrame) -> DataFrame:
    """Compute once, store as a table, go on from the stored rows.

    For results that several branches of a job read: the facts are scanned once, a lost executor costs a re-read instead
    of a re-computation, and the planner knows the true size of what follows. See ``scratch`` for when they go.
    """
    path = new_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
