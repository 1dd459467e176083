from __future__ import annotations

import hashlib
import random
import re
import time
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from staylift.llm import pseudonyms as p
from staylift.llm.queries import documents

KEY = "k1"
SCHEMA = "doc_id LONG, text STRING, hits STRING, made STRING, record STRING, kind STRING"


def drawn(kind: str, *parts) -> int:
    return int(hashlib.sha256("|".join([KEY, kind, *map(str, parts)]).encode()).hexdigest()[:15], 16)


def number(kind: str, value: int, left: int, right: int) -> int:
    a, b = divmod(value, right)
    for t in range(p.ROUNDS):
        if t % 2 == 0:
            a = (a + drawn(kind, t, b)) % left
        else:
            b = (b + drawn(kind, t, a)) % right
    return a * right + b


def characters(kind: str, text: str) -> str:
    half = len(text) // 2
    parts = [text[:half], text[half:]]
    for t in range(p.ROUNDS):
        own, other = parts[t % 2], parts[1 - t % 2]
        out = ""
        for i, c in enumerate(own, 1):
            for first, last in ("az", "AZ", "09"):
                if first <= c <= last:
                    size = ord(last) - ord(first) + 1
                    c = chr(ord(first) + (ord(c) - ord(first) + drawn(kind, t, other, i) % size) % size)
                    break
            out += c
        parts[t % 2] = out
    return "".join(parts)


def luhn(digits: str) -> int:
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))


def spread(digits: str, form: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in form)


def one(kind: str, hit: str) -> str | None:
    """The pseudonym of a value, or None where it is not valid."""
    if kind == "card":
        digits = re.sub(r"\D", "", hit)
        if luhn(digits) % 10:
            return None
        body = digits[0] + characters(kind, digits[1:-1])
        return spread(body + str(-luhn(body + "0") % 10), hit)
    if kind == "ip":
        parts = hit.split(".")
        if any(int(x) > 255 or str(int(x)) != x for x in parts):
            return None
        v = number(kind, int.from_bytes(bytes(map(int, parts))), 1 << 16, 1 << 16)
        return ".".join(map(str, v.to_bytes(4)))
    if kind == "date":
        form = "%Y-%m-%d" if "-" in hit else "%d.%m.%Y" if "." in hit else "%Y/%m/%d" if hit[4] == "/" else "%m/%d/%Y"
        found = re.fullmatch(re.sub(r"%(.)", lambda m: rf"(?P<{m[1]}>\\d+)".replace("\\\\", "\\"), form.replace(".", r"\.")), hit)
        try:
            day = date(int(found["Y"]), int(found["m"]), int(found["d"]))
        except ValueError:
            return None
        if not 1800 <= day.year <= 2199:
            return None
        start = date.fromisoformat(p.CYCLE_START)
        return (start + timedelta(number(kind, (day - start).days, *p.CYCLE))).strftime(form)
    if kind == "ssn":
        a, g, s = map(int, hit.split("-"))
        if not 1 <= a <= 899 or a == 666 or not g or not s:
            return None
        v = number(kind, ((a - 1 - (a > 666)) * 99 + g - 1) * 9999 + s - 1, *p.SSN)
        first, s = divmod(v, 9999)
        a, g = divmod(first, 99)
        return f"{a + 1 + (a >= 665):03d}-{g + 1:02d}-{s + 1:04d}"
    if kind == "phone":
        tail = re.search(r"\(?\d{3}\)?[ .-]?\d{3}[ .-]\d{4}$", hit)[0]
        return hit[: -len(tail)] + characters(kind, tail)
    if kind == "email":
        local, domain = hit.split("@")
        return f"{characters(kind, local)}@{domain}"
    value = re.search(r"[\w-]+$", hit, re.ASCII)[0]
    return hit[: -len(value)] + characters(kind, value)


def plain(text: str | None) -> tuple[str | None, list]:
    if text is None:
        return None, []
    found = []

    def swap(m: re.Match) -> str:
        for kind, pattern in p.PATTERNS.items():
            if ("\"" in m[0] or "'" in m[0]) if kind == "secret" else re.fullmatch(pattern, m[0], re.ASCII):
                new = one(kind, m[0])
                if new is not None:
                    found.append((kind, new))
                return m[0] if new is None else new
        return m[0]

    return re.sub("|".join(f"(?:{x})" for x in p.PATTERNS.values()), swap, text, flags=re.ASCII), found


def card(r: random.Random, n: int) -> str:
    body = "".join(r.choice("0123456789") for _ in range(n - 1))
    return body + str(-luhn(body + "0") % 10)


def texts() -> list:
    r = random.Random(9)
    out = [
        None, "", " ", "nothing here", "mail und.34@mail7.example.com, x@y.org.", "a+B_c%9@sub-1.example.co.uk!", "no@tld",
        "call +1 (017) 555-7713 or (234) 555-0199 or 234-555-0199 or +44 234.555.0199", "97.51.17.173 256.1.1.1 1.2.3 01.2.3.4 0.0.0.0 255.255.255.255 v1.2.3.4.5",
        "on 2024-02-29 and 2023-02-29, 1999/12/31; 31.12.1999 12/31/1999 31/12/1999 0001-01-01 1800-01-01 2199-12-31 2024-13-01",
        "ssn 123-45-6789 000-12-3456 666-12-3456 900-12-3456 123-00-4567 665-99-9999 667-01-0001", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"',
        "password: 'Abc-def_12345678' TOKEN = 'ABCDEF0123456789' api_key=\"short\"", "4111 1111 1111 1111 4111-1111-1111-1111 378282246310005 3782 822463 10005 4111111111111112",
        "É4111111111111111É 12345678901234567890", "4111111111111111 4111111111111111\n4111111111111111", "x" * 200_000 + " 10.0.0.1", "9" * 5000, "a.b" * 3000 + "@" + "c." * 3000,
    ]
    for _ in range(60):
        n = r.randrange(13, 20)
        day = date(1800, 1, 1) + timedelta(r.randrange(146_097))
        out.append(f"card {card(r, n)} {card(r, 16)[:-1]}x {r.randrange(256)}.{r.randrange(256)}.{r.randrange(256)}.{r.randrange(256)} {day} u{r.randrange(99)}@e.com")
    return out


def made(spark, rows, **options):
    return p.pseudonymised(spark.createDataFrame(rows, SCHEMA).repartition(3), **{"key": KEY} | options)


def test_as_brute_force(spark):
    rows = [(i, t, "h", "m", "r", "k") for i, t in enumerate(texts())]
    got = {r.record.doc_id: r for r in made(spark, rows).collect()}
    kinds = set()
    for i, text, *_ in rows:
        new, found = plain(text)
        assert got[i].text == new and [tuple(x) for x in got[i].found] == found, text
        assert {k: got[i][f"n_{k}"] for k in p.KINDS} == {k: sum(x == k for x, _ in found) for k in p.KINDS}
        kinds |= {k for k, _ in found}
    assert kinds == set(p.KINDS)


def test_the_key_turns_it_back(spark):
    rows = [(i, t, *[None] * 4) for i, t in enumerate(texts())]
    there = made(spark, rows).select("record.doc_id", "text", *[F.lit("").alias(c) for c in ("hits", "made", "record", "kind")])
    back = p.pseudonymised(there, KEY, back=True)
    assert {r.record.doc_id: r.text for r in back.collect()} == {i: t for i, t, *_ in rows}
    other = p.pseudonymised(there, "another key", back=True)
    assert sum(r.text == rows[r.record.doc_id][1] for r in other.collect()) < 12


@pytest.mark.parametrize(("left", "right"), [(7, 11), (1, 5), (189, 773)])
def test_numbers_are_permuted(spark, left, right):
    n = left * right
    df = spark.range(n).select("id", p.Permutation(KEY, "x").number(F.col("id"), left, right).alias("v"))
    got = {r.id: r.v for r in df.collect()}
    assert sorted(got.values()) == list(range(n))
    assert all(got[i] == number("x", i, left, right) for i in range(0, n, 97))


def test_equal_values_stay_linked(spark):
    got = made(spark, [(1, "ip 8.8.4.4 a", *[None] * 4), (2, "b 8.8.4.4", *[None] * 4), (2, "b 8.8.4.4", *[None] * 4)]).collect()
    assert len({r.found[0].text for r in got}) == 1 and all(r.found[0].text != "8.8.4.4" for r in got) and len(got) == 3


def test_day_first(spark):
    got = made(spark, [(1, "31/12/1999 12/31/1999", *[None] * 4)], day_first=True).collect()[0]
    assert got.n_date == 1 and got.text.endswith(" 12/31/1999") and got.text != "31/12/1999 12/31/1999"


def test_real_documents_as_brute_force(spark):
    docs = documents(spark, "/root/testdata/sf0.001").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in p.pseudonymised(docs, KEY).collect():
        assert r.text == plain(texts[r.record.doc_id])[0]


def test_empty_table(spark):
    assert made(spark, []).collect() == []


def test_no_python_in_the_plan(spark):
    plan = made(spark, [(1, "x", *[None] * 4)])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_runs_of_signs_take_linear_time(spark):
    """Texts of 200,000 signs that begin many a value and end none; a short table warms up first."""
    def seconds(texts):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING").coalesce(1)
        began = time.perf_counter()
        p.pseudonymised(docs, key="k").write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    runs = ["%41" * 66_000, "a%20b" * 40_000, "%" * 200_000, "." * 200_000, " " * 200_000, "a." * 100_000, "1" * 200_000, "a@" * 100_000, "token='" * 28_000]
    short = seconds([x[:2000] for x in runs])
    assert seconds(runs) < short + 9


def test_addresses_behind_percent_signs(spark):
    texts = ["%20alice@example.com", "a%20alice@example.com", "x %40 bob@example.com", "%%alice@example.com", "mailto:%22carol@example.com%22"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    got = {r.record.doc_id: r.text for r in p.pseudonymised(docs, key="k").collect()}
    assert [got[i] != t for i, t in enumerate(texts)] == [True, True, True, False, True]
    assert all("@example.com" in got[i] for i in range(5))
