"""Personal data replaced by format-preserving pseudonyms: keyed Feistel permutations of validated values.

A value keeps its format and stays valid, and equal values get equal pseudonyms in all documents, so that links between
documents survive. Whoever has the key can turn the permutation back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10

#: How the kinds are written. The first alternative that matches at a place decides; a value must then pass its check.
PATTERNS = {
    # A run of its signs is entered at its beginning, or behind a percent sign there, so that it is read no more than twice.
    "email": r"(?:(?<![\w.+%-])|(?<=(?<![\w.+%-])%))[A-Za-z0-9][\w.+%-]*+@[A-Za-z0-9][A-Za-z0-9.-]*\.[A-Za-z]{2,}",
    "secret": r"(?:(?i:token|secret|password|passwd|api_?key) {0,2}[=:] {0,2}[\"'])[\w-]{12,}+(?=[\"'])",
    "ip": r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\w]|\.\d)",
    "date": r"(?<![\w./-])(?:\d{4}-\d\d-\d\d|\d{4}/\d\d/\d\d|\d\d\.\d\d\.\d{4}|\d\d/\d\d/\d{4})(?![\w]|[./-]\d)",
    "phone": r"(?<![\w.+-])(?:(?:\+\d{1,3}[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|(?:\+\d{1,3}[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4})(?![\w]|[.-]\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w.])(?:\d{13,19}|\d{4}-\d{4}-\d{4}-\d{1,7}|\d{4} \d{4} \d{4} \d{1,7}|\d{4}([ -])\d{6}\1\d{5})(?![\w]|\.\d)",
}
KINDS = list(PATTERNS)
#: Months of 31 days, and the first day of a Gregorian cycle of 400 years: 146,097 days, which is 189 times 773.
CYCLE_START, CYCLE = "1800-01-01", (189, 773)
#: Area numbers 001-665 and 667-899 with groups 01-99; serials 0001-9999.
SSN = (898 * 99, 9999)


def _any_pattern() -> str:
    # The only back reference counts groups from the left, and no other pattern captures.
    return "|".join(f"(?:{p})" for p in PATTERNS.values())


@dataclass(frozen=True)
class Permutation:
    """The keyed permutation of one kind of value, forwards or back."""

    key: str
    kind: str
    back: bool = False

    def _drawn(self, turn: Column, other: Column, place: Column | None = None) -> Column:
        """A number below 2**60 from the key, the round, the other half and the place of a character."""
        parts = [F.lit(self.key), F.lit(self.kind), turn.cast("string"), other.cast("string")]
        parts += [] if place is None else [place.cast("string")]
        digest = F.sha2(F.concat_ws("|", *parts).cast("binary"), 256)
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")

    def _turns(self) -> Column:
        turns = range(ROUNDS)
        return F.array(*[F.lit(t) for t in (reversed(turns) if self.back else turns)])

    def _moved(self, value: Column, by: Column, modulus: Column | int) -> Column:
        modulus = F.lit(modulus) if isinstance(modulus, int) else modulus
        return F.pmod(value - by if self.back else value + by, modulus)

    def number(self, value: Column, left: int, right: int) -> Column:
        """Permute [0, left * right): the halves, modulo ``left`` and ``right``, are moved in turn by a hash of the other."""
        start = F.struct(F.floor(value / right).cast("long").alias("a"), F.pmod(value, F.lit(right)).cast("long").alias("b"))

        def turned(s: Column, t: Column) -> Column:
            even = t % 2 == 0
            a = F.when(even, self._moved(s["a"], self._drawn(t, s["b"]), left)).otherwise(s["a"])
            b = F.when(even, s["b"]).otherwise(self._moved(s["b"], self._drawn(t, s["a"]), right))
            return F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

        return F.aggregate(self._turns(), start, turned, lambda s: s["a"] * right + s["b"])

    def characters(self, text: Column) -> Column:
        """Permute the strings of a format: digits among digits, letters among letters of their case, others stay.

        The halves of the string are moved in turn, each character within its class, by a hash of the other half.
        """
        middle = F.floor(F.length(text) / 2).cast("int")
        start = F.struct(F.substr(text, F.lit(1), middle).alias("a"), F.substr(text, middle + 1).alias("b"))

        def moved(half: Column, other: Column, t: Column) -> Column:
            def one(i: Column) -> Column:
                c = F.substr(half, i, F.lit(1))
                code, by = F.ascii(c).cast("long"), self._drawn(t, other, i)
                out = c
                for first, last in ("az", "AZ", "09"):
                    size = ord(last) - ord(first) + 1
                    inside = F.chr((self._moved(code - ord(first), by % size, size) + ord(first)).cast("long"))
                    out = F.when(c.between(first, last), inside).otherwise(out)
                return out

            places = F.when(half == "", F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(half))))
            return F.array_join(F.transform(places, one), "")

        def turned(s: Column, t: Column) -> Column:
            even = t % 2 == 0
            a = F.when(even, moved(s["a"], s["b"], t)).otherwise(s["a"])
            b = F.when(even, s["b"]).otherwise(moved(s["b"], s["a"], t))
            return F.struct(a.alias("a"), b.alias("b"))

        return F.aggregate(self._turns(), start, turned, lambda s: F.concat(s["a"], s["b"]))


def luhn_sum(digits: Column) -> Column:
    """Sum of a digit string by the check-digit rule: from the right, every second digit doubled, its digits added."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, n - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


def _spread(digits: Column, form: Column) -> Column:
    """Write digits into the digit places of ``form``, whose separators stay."""
    places = F.sequence(F.lit(1), F.length(form))
    empty = F.struct(F.lit("").alias("out"), F.lit(1).alias("next"))

    def put(s: Column, i: Column) -> Column:
        c = F.substr(form, i, F.lit(1))
        digit = c.between("0", "9")
        out = F.concat(s["out"], F.when(digit, F.substr(digits, s["next"], F.lit(1))).otherwise(c))
        return F.struct(out.alias("out"), (s["next"] + digit.cast("int")).alias("next"))

    return F.aggregate(places, empty, put, lambda s: s["out"])


def _card(hit: Column, p: Permutation) -> tuple[Column, Column]:
    """Valid by check digit. The first digit stays, the check digit follows from the others."""
    digits = F.regexp_replace(hit, "[^0-9]", "")
    n = F.length(digits)
    body = F.concat(F.substr(digits, F.lit(1), F.lit(1)), p.characters(F.substr(digits, F.lit(2), n - 2)))

    def closed(b: Column) -> Column:
        check = F.pmod(F.lit(10) - luhn_sum(F.concat(b, F.lit("0"))) % 10, F.lit(10))
        return _spread(F.concat(b, check.cast("string")), hit)

    return luhn_sum(digits) % 10 == 0, F.get(F.transform(F.array(body), closed), F.lit(0))


def _ip(hit: Column, p: Permutation) -> tuple[Column, Column]:
    """Four numbers up to 255 without leading zeros; permuted as 32 bits."""
    parts = F.split(hit, r"\.")
    valid = F.forall(parts, lambda x: (x.cast("int") <= 255) & (x == x.cast("int").cast("string")))
    value = F.aggregate(parts, F.lit(0).cast("long"), lambda total, x: total * 256 + x.cast("long"))

    def written(v: Column) -> Column:
        return F.concat_ws(".", *[F.floor(v / 256**k).cast("long") % 256 for k in (3, 2, 1, 0)])

    return valid, F.get(F.transform(F.array(p.number(value, 1 << 16, 1 << 16)), written), F.lit(0))


def _date(hit: Column, p: Permutation, day_first: bool) -> tuple[Column, Column]:
    """A day of the calendar from 1800 to 2199, permuted among these."""
    year_first = hit.rlike(r"^\d{4}")
    dotted = F.contains(hit, F.lit("."))
    two = [F.substr(hit, F.lit(k), F.lit(2)).cast("int") for k in (1, 4, 6, 9)]
    day_leads = dotted | F.lit(day_first)
    year = F.when(year_first, F.substr(hit, F.lit(1), F.lit(4))).otherwise(F.substr(hit, F.lit(7), F.lit(4))).cast("int")
    month = F.when(year_first, F.substr(hit, F.lit(6), F.lit(2)).cast("int")).when(day_leads, two[1]).otherwise(two[0])
    day = F.when(year_first, F.substr(hit, F.lit(9), F.lit(2)).cast("int")).when(day_leads, two[0]).otherwise(two[1])
    sound = year.between(1800, 2199) & month.between(1, 12) & (day >= 1)
    valid = F.when(sound, day <= F.dayofmonth(F.last_day(F.make_date(year, month, F.lit(1))))).otherwise(F.lit(False))
    origin = F.lit(CYCLE_START).cast("date")
    number = p.number(F.datediff(F.make_date(year, month, day), origin).cast("long"), *CYCLE)

    def written(v: Column) -> Column:
        d = F.date_add(origin, v.cast("int"))
        dash = F.contains(hit, F.lit("-"))
        leading = F.when(dash, F.date_format(d, "yyyy-MM-dd")).otherwise(F.date_format(d, "yyyy/MM/dd"))
        closing = F.when(dotted, F.date_format(d, "dd.MM.yyyy")).otherwise(F.date_format(d, "dd/MM/yyyy" if day_first else "MM/dd/yyyy"))
        return F.when(year_first, leading).otherwise(closing)

    return valid, F.get(F.transform(F.array(number), written), F.lit(0))


def _ssn(hit: Column, p: Permutation) -> tuple[Column, Column]:
    area, group, serial = (F.element_at(F.split(hit, "-"), k).cast("long") for k in (1, 2, 3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = (area - 1 - (area > 666).cast("long")) * 99 + group - 1
    number = p.number(index * SSN[1] + serial - 1, *SSN)

    def written(v: Column) -> Column:
        first = F.floor(v / SSN[1]).cast("long")
        a = F.floor(first / 99).cast("long") + 1
        parts = [(a + (a >= 666).cast("long"), 3), (first % 99 + 1, 2), (v % SSN[1] + 1, 4)]
        return F.concat_ws("-", *[F.lpad(x.cast("string"), n, "0") for x, n in parts])

    return valid, F.get(F.transform(F.array(number), written), F.lit(0))


def _phone(hit: Column, p: Permutation) -> tuple[Column, Column]:
    """Ten digits after an optional country code, which stays."""
    tail = F.regexp_extract(hit, r"\(?\d{3}\)?[ .-]?\d{3}[ .-]\d{4}$", 0)
    return F.length(tail) > 0, F.concat(F.substr(hit, F.lit(1), F.length(hit) - F.length(tail)), p.characters(tail))


def _email(hit: Column, p: Permutation) -> tuple[Column, Column]:
    """The local part is permuted, the domain stays."""
    at = F.instr(hit, "@")
    return at > 1, F.concat(p.characters(F.substr(hit, F.lit(1), at - 1)), F.substr(hit, at))


def _secret(hit: Column, p: Permutation) -> tuple[Column, Column]:
    """The quoted value is permuted, its name stays."""
    value = F.regexp_extract(hit, r"[\w-]+$", 0)
    return F.length(value) > 0, F.concat(F.substr(hit, F.lit(1), F.length(hit) - F.length(value)), p.characters(value))


def _replaced(hit: Column, key: str, back: bool, day_first: bool) -> Column:
    """kind (null: none) and text of one match."""
    rules = {"email": _email, "secret": _secret, "ip": _ip, "date": lambda h, p: _date(h, p, day_first), "phone": _phone, "ssn": _ssn, "card": _card}
    kind = F.lit(None).cast("string")
    for name in reversed(KINDS):
        # A secret is the only match that holds a quote; its closing one is not part of it.
        alike = hit.rlike("[\"']") if name == "secret" else hit.rlike(f"^(?:{PATTERNS[name]})$")
        kind = F.when(alike, F.lit(name)).otherwise(kind)

    def of_kind(k: Column) -> Column:
        out = F.struct(F.lit(None).cast("string").alias("kind"), hit.alias("text"))
        for name, rule in rules.items():
            valid, text = rule(hit, Permutation(key, name, back))
            out = F.when((k == name) & valid, F.struct(k.alias("kind"), text.alias("text"))).otherwise(out)
        return out

    return F.get(F.transform(F.array(kind), of_kind), F.lit(0))


def pseudonymised(docs: DataFrame, key: str, back: bool = False, day_first: bool = False) -> DataFrame:
    """Every document with its personal data replaced: record (the row without its text), text, found, and the
    number of values of each kind (n_email, n_secret, n_ip, n_date, n_phone, n_ssn, n_card).

    Values are replaced when they are valid: cards by check digit, addresses by range, dates by calendar, social security
    numbers by range, phone numbers by length; anything else that looks alike stays as it is. ``found`` lists kind
    and pseudonym in order. ``back`` turns pseudonyms of the same ``key`` into the values again. Slash dates that start
    with two digits are month first unless ``day_first``. A null text stays null with nothing found; other columns
    are not looked at, whatever their names. The key is a secret of the caller; it never enters the result.
    """
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("record"), "text")
    pattern = F.lit(_any_pattern())
    # Most texts have no digit, sign or quoted value at all, and are not searched further.
    hits = F.when(F.col("text").rlike(r"[0-9@]|[=:] {0,2}[\"']"), F.regexp_extract_all("text", pattern, F.lit(0)))
    rows = rows.withColumn("hits", F.coalesce(hits, F.array().cast("array<string>")))
    rows = rows.withColumn("made", F.transform("hits", lambda h: _replaced(h, key, back, day_first)))
    pieces = F.split("text", _any_pattern(), -1)
    joined = F.array_join(F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.get("made", i)["text"], F.lit("")))), "")
    rows = rows.withColumn("text", F.when(F.size("hits") > 0, joined).otherwise(F.col("text")))
    found = F.filter("made", lambda m: m["kind"].isNotNull())
    rows = rows.select("record", "text", found.alias("found"))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda m: m["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return rows.select("record", "text", "found", *counts)
