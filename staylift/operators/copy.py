"""Generated copy: parse raw responses into subject and body, keep what cannot be parsed apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylift.functions.text import fix_words, strip

FENCE = "```"
KEYS = ("subject", "body")


def _json_text(response: Column) -> Column:
    """The text inside the first fence, without its ``json`` tag, or the whole text if unfenced."""
    text = strip(response)
    inside = F.split_part(text, F.lit(FENCE), F.lit(2))
    untagged = F.when(F.startswith(inside, F.lit("json")), F.substr(inside, F.lit(5))).otherwise(inside)
    return strip(F.when(F.contains(text, F.lit(FENCE)), untagged).otherwise(text))


def _once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a column behind a generator, which keeps the optimizer from computing it again wherever it is used."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _parsed(responses: DataFrame) -> DataFrame:
    texts = _once(responses, _json_text(F.col("response")), "json_text")
    parsed = _once(texts, F.from_json("json_text", "map<string,string>", {"allowSingleQuotes": "false"}), "fields")
    # A key that is present but null cannot be word-fixed, so it rejects the response; an absent one is "".
    present_null = F.exists(
        F.map_entries("fields"), lambda e: e["key"].isin(*KEYS) & e["value"].isNull()
    )
    complete = F.startswith(F.col("json_text"), F.lit("{")) & F.endswith(F.col("json_text"), F.lit("}"))
    return parsed.withColumn("usable", F.coalesce(complete & F.col("fields").isNotNull() & ~present_null, F.lit(False)))


def parse_copy(responses: DataFrame) -> DataFrame:
    """Rows whose response is an object: the other columns, plus word-fixed ``subject`` and ``body``."""
    texts = {key: fix_words(F.coalesce(F.try_element_at("fields", F.lit(key)), F.lit(""))) for key in KEYS}
    return _parsed(responses).filter("usable").withColumns(texts).drop("response", "json_text", "fields", "usable")


def copy_rejects(responses: DataFrame) -> DataFrame:
    """Rows whose response could not be parsed, with the raw response."""
    return _parsed(responses).filter(~F.col("usable")).drop("json_text", "fields", "usable")


def last_copy(copies: DataFrame, order: str) -> DataFrame:
    """One copy per accommodation: the one made last. Combines map-side; equal ``order`` falls to the greater text."""
    latest = F.max(F.struct(F.col(order).alias("made"), "subject", "body"))
    return copies.groupBy("acm_id").agg(latest.alias("c")).select("acm_id", "c.subject", "c.body")


def with_copy(targets: DataFrame, copies: DataFrame, *, required: bool, order: str | None = None) -> DataFrame:
    """Join ``subject`` and ``body`` to a list of targets.

    ``copies`` are raw responses (column ``response``) or parsed ones. They are first reduced to the listed ids, before
    any parsing, and then to each id's last copy by the column ``order``; without one, an id is expected to have one copy.
    ``targets`` is read twice and should be stored or small. What is sent around is Spark's choice by size.
    """
    wanted = copies.join(targets.select("acm_id").distinct(), "acm_id", "left_semi")
    if "response" in copies.columns:
        wanted = parse_copy(wanted)
    if order is None:
        wanted, order = wanted.withColumn("made", F.lit(0)), "made"
    joined = targets.drop(*KEYS).join(last_copy(wanted, order).withColumn("has_copy", F.lit(True)), "acm_id", "inner" if required else "left")
    return joined.withColumn("has_copy", F.coalesce("has_copy", F.lit(False)))
