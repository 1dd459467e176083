"""Literal text work: word fixes, placeholder filling, conditional blocks."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mixed-script slips in generated copy and their corrections, applied in this order.
# The entries with a particle never fire, because the bare word before them has already been replaced.
WORD_FIXES = [
    ("쿠pon", "쿠폰"), ("쿠Pon", "쿠폰"), ("쿠PON", "쿠폰"),
    ("이vent", "이벤트"), ("이Vent", "이벤트"), ("이ven트", "이벤트"),
    ("쿠pon이", "쿠폰이"), ("쿠pon을", "쿠폰을"), ("쿠pon은", "쿠폰은"),
    ("coupon", "쿠폰"), ("Coupon", "쿠폰"), ("COUPON", "쿠폰"),
    ("push", "푸시"), ("PUSH", "푸시"),
    ("marketing", "마케팅"), ("Marketing", "마케팅"),
    ("package", "패키지"), ("Package", "패키지"),
]


def fix_words(text: Column, fixes: list[tuple[str, str]] = WORD_FIXES) -> Column:
    return reduce(lambda t, fix: F.replace(t, F.lit(fix[0]), F.lit(fix[1])), fixes, text)


#: White space of any kind, line ends and wide blanks included.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove leading and trailing white space."""
    return F.btrim(text, F.lit(BLANKS))


def facts(*rows: tuple) -> Column:
    """``label: value`` lines from (label, value) or (label, value, condition); unknown and unwanted facts have no line."""
    lines = []
    for label, value, *condition in rows:
        line = F.concat(F.lit(f"{label}: "), value.cast("string"))
        lines.append(F.when(condition[0], line) if condition else line)
    return F.concat_ws("\n", *lines)


def fill(template: Column, values: dict[str, Column]) -> Column:
    """Replace ``{{key}}`` by its value, key after key, so later values see earlier insertions."""
    return reduce(
        lambda t, item: F.replace(t, F.lit("{{" + item[0] + "}}"), item[1].cast("string")), values.items(), template
    )


def optional_block(text: Column, name: str, keep: Column) -> Column:
    """Keep what stands between ``{{#if_name}}`` and ``{{/if_name}}``, or delete it with its markers."""
    start, end = "{{#if_" + name + "}}", "{{/if_" + name + "}}"
    kept = F.replace(F.replace(text, F.lit(start), F.lit("")), F.lit(end), F.lit(""))
    dropped = F.regexp_replace(text, "(?s)" + re.escape(start) + ".*?" + re.escape(end), "")
    return F.when(keep, kept).otherwise(dropped)
