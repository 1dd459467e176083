"""HTML templates."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession

BUNDLED = Path(__file__).resolve().parent.parent / "templates"


def load_template(spark: SparkSession, path: str) -> DataFrame:
    """One row, column ``value``: the whole file, which must be readable by every executor."""
    return spark.read.text(path, wholetext=True)


def as_column(template: DataFrame | str) -> Column:
    """A template as an expression: a literal, or a scalar subquery over its one row."""
    from pyspark.sql import functions as F

    return F.lit(template) if isinstance(template, str) else template.scalar()


def bundled(name: str) -> str:
    """Text of a template shipped with the package, for use as a literal."""
    return (BUNDLED / name).read_text(encoding="utf-8")
