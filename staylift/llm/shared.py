"""What several operators need: word and letter-case rules; numbering and checkpoints are the library's own."""

from __future__ import annotations

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from staylift.operators.numbering import checkpointed, running_total

__all__ = ["SPACE", "SPACES", "ascii_lower", "checkpointed", "other_columns", "running_total", "trimmed", "word_count", "words_of"]

#: The six white-space characters that part words; every other character belongs to a word.
SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


@F.arrow_udf(StringType())
def ascii_lower(text):
    """Lower-case A-Z and nothing else; null stays null."""
    return pc.ascii_lower(text)


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def words_of(text: Column) -> Column:
    """The words of a text in order; no words for null, empty and blank texts."""
    return F.filter(F.split(trimmed(F.coalesce(text, F.lit(""))), SPACE), lambda w: w != "")


def word_count(text: Column) -> Column:
    bare = trimmed(F.coalesce(text, F.lit("")))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, SPACE))).cast("long")


def other_columns(docs: DataFrame, whole: str) -> Column:
    """All columns but doc_id and text of a row packed as ``whole``, as text, which orders rows that tie in these two."""
    others = [F.col(f"{whole}.`{c}`").alias(str(k)) for k, c in enumerate(docs.columns) if c not in {"doc_id", "text"}]
    return F.to_json(F.struct(*others)) if others else F.lit("")
