from __future__ import annotations

import inspect
import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from staylift.llm import mcd_quality as m
from staylift.llm.queries import documents

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, words STRING, grp STRING, rows INT, n INT, kept INT"
SPACE = " \t\n\x0b\x0c\r"


def words(text: str) -> list[str]:
    for c in SPACE[1:]:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def counts(text: str | None) -> tuple:
    text = text or ""
    w, lines = words(text), [x for x in text.split("\n") if words(x)]
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {k for i in range(len(w) - 2) if windows[w[i], w[i + 1], w[i + 2]] > 1 for k in (i, i + 1, i + 2)}
    n = len(w)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(covered), failed


def odd_texts() -> list:
    r = random.Random(4)
    texts = ["", None, " \n\t", "one", "a b c a b c", "a a a a a a", "x y z q x y z", "É É É\nÉ É É\n", "a\n b\na\n\n\n", "#*$%&|<> ok"]
    for _ in range(200):
        vocab = [f"w{i}" for i in range(r.choice([2, 5, 30, 500]))]
        texts.append("".join(r.choice(vocab) + r.choice([" ", "  ", "\n", "\t", "\r\n", "#"]) for _ in range(r.randrange(1, 200))))
    return [*texts, "same three words " * 4000, " ".join(f"n{i}" for i in range(30_000)) + " n1 n2 n3"]


def test_counts_as_brute_force(spark):
    rows = [(i, t, "en", "s", *[None] * 5) for i, t in enumerate(odd_texts())]
    got = m.statistics(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got} == {
        i: counts(t) for i, t, *_ in rows
    }


def test_counts_are_exact_when_hashes_collide(spark):
    r = random.Random(9)
    texts = [" ".join(r.choice([f"w{i}" for i in range(size)]) for _ in range(r.randrange(4, 150))) for size in (2, 5, 9, 30, 500) for _ in range(20)]
    rows = [(i, t, *[None] * 7) for i, t in enumerate([*texts, "a b c d e f a b c", "a b c x y z a b c x y z q"])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("words", m.words_of(F.col("text")))
    n = F.size("words")
    last = (n - 3).cast("int")
    # Hashes that tell nothing, and hashes of three values: windows that differ stand between equal ones.
    none = F.transform(F.sequence(F.lit(0), last), lambda i: F.lit(0).cast("long"))
    few = F.transform(F.sequence(F.lit(0), last), lambda i: F.pmod(F.xxhash64(F.get("words", i)), F.lit(3)).bitwiseXOR(F.lit(1)) * (1 << 60))
    exact = m._covered_by_words(F.col("words"), n)
    got = df.select("doc_id", *[f.alias(k) for k, f in (("a", m._covered(none, F.col("words"), n)), ("b", m._covered(few, F.col("words"), n)), ("c", exact))])
    for x in got.collect():
        assert x.a == x.b == x.c == counts(rows[x.doc_id][1])[5], rows[x.doc_id][1]


def plain_estimate(x: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Concentration steps on the rows themselves."""
    least = np.diag([(s * m.SCALE) ** 2 for s in m.SPREAD.values()])

    def median(v):
        return np.sort(v, axis=0)[(len(v) + 1) // 2 - 1]

    centre = median(x)
    z = (x - centre) ** 2 / ((1.4826 * median(np.abs(x - centre))) ** 2 + np.diag(least))
    best = None
    for d in (z.sum(axis=1), z.max(axis=1) * m.P):
        rest = None
        while True:
            bins = np.minimum(np.floor(np.log2(1 + d) * 128), m.BINS - 1)
            core = bins <= np.sort(bins)[math.ceil(share * len(x)) - 1]
            mean = x[core].mean(axis=0)
            cov = np.cov(x[core].T, bias=True) * m.consistency(share) + least
            if rest is not None and np.linalg.slogdet(cov)[1] >= rest[2] - 1e-9:
                break
            d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
            rest = (mean, cov, np.linalg.slogdet(cov)[1], d)
        mean, cov, _, d = rest
        if best is None or np.linalg.slogdet(cov)[1] < best[2] - 1e-9:
            best = (mean, cov, np.linalg.slogdet(cov)[1], d)
    return best[3]


def test_distances_as_brute_force(spark):
    r = np.random.default_rng(3)
    rows = []
    for group, n in (("a", 400), ("b", 61), ("c", 30)):
        x = r.multivariate_normal([200, 0, 10, 20], np.diag([9, 1, 400, 900]) + 20, n)
        x[: n // 6] += [60, 90, 0, 0]
        rows += [(group, *map(int, np.round(v))) for v in x]
    df = spark.createDataFrame(rows, "grp STRING, v_length LONG, v_symbols LONG, v_lines LONG, v_repeats LONG")
    estimates = m.robust_estimates(df.repartition(5), 0.75)
    measured = df.join(estimates, "grp")
    got: dict = {}
    for x in measured.select("grp", *m.VECTOR, m._distance(measured).alias("d")).collect():
        got[tuple(x)[:5]] = x.d
    for group in "abc":
        own = [x for x in rows if x[0] == group]
        expected = plain_estimate(np.array([x[1:] for x in own], float), 0.75)
        assert np.allclose([got[x] for x in own], expected, rtol=1e-6, atol=1e-6)
        planted = len(own) // 6
        assert expected[:planted].min() > m.chi2_quantile(1 - 1e-6, 4) > expected[planted:].max()


def test_chi2():
    assert abs(m.chi2_quantile(0.75, 4) - 5.38527) < 1e-4 and abs(m.chi2_quantile(0.95, 4) - 9.48773) < 1e-4


def test_small_groups_are_pooled(spark):
    rows = [("en", "s1")] * 40 + [("en", "s2")] * 10 + [("en", None)] * 25 + [("de", "s1")] * 5 + [(None, None)] * 3
    got = m.grouped(spark.createDataFrame(rows, "lang STRING, source STRING"), 30).groupBy("grp").count().collect()
    assert sorted(x["count"] for x in got) == [8, 35, 40]


def test_nulls_repeats_and_clashing_names(spark):
    clean = [(i, " ".join(f"word{(i * 31 + k) % 997}" for k in range(60)), ["en", None][i % 2], None, *[None] * 5) for i in range(90)]
    rows = [*clean, clean[5], (None, clean[7][1], "en", "x", *[None] * 5), (500, None, None, None, *[None] * 5), (501, "", "en", "x", *[None] * 5)]
    rows += [(502, " ".join(f"#{k}#$%" for k in range(70)), "en", None, *[None] * 5)]
    got = m.judged(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert Counter(x.doc_id for x in got) == Counter(x[0] for x in rows)
    assert {x.doc_id for x in got if not x.kept} == {500, 501, 502}
    assert m.judged(spark.createDataFrame([], SCHEMA)).collect() == []


def test_rejects_junk_and_keeps_clean_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    got = m.judged(documents(spark, sf)).filter("NOT base_failed").join(labels, "doc_id")
    shares = {r.quality: r.kept for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert shares[1] > 0.99 and shares[0] < 0.1, shares


def test_repeated_lines_and_phrases_are_rejected_among_clean_words(spark):
    r = random.Random(8)

    def distinct(n: int) -> list[str]:
        return ["".join(r.choice("abcdefghij") for _ in range(8)) for _ in range(n)]

    clean = [" ".join(distinct(120)) for _ in range(60)]
    line, phrase = " ".join(distinct(7)), distinct(9)
    lines = "\n".join([line] * 14 + [" ".join(distinct(100))])
    # A line that repeats and is too short to repeat a window of three words, and a phrase that repeats on no line.
    short = "\n".join(" ".join(distinct(2)) if i % 2 else "aaaaaaaa bbbbbbbb" for i in range(80))
    phrases = " ".join(w for _ in range(10) for w in [*phrase, *distinct(10)])
    rows = [(i, t, "en", "s", *[None] * 5) for i, t in enumerate([*clean, lines, short, phrases])]
    got = {x.doc_id: x for x in m.judged(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not any(x.base_failed for x in got.values())
    assert (got[60].n_dup_lines, got[60].n_repeat_words) == (13, 98) and got[61].n_repeat_words == 0 == got[62].n_dup_lines
    assert {i for i, x in got.items() if not x.kept} == {60, 61, 62}


def test_every_statistic_can_reject_alone():
    most = {"v_length": 1.0, "v_symbols": 1.0, "v_lines": 1.0, "v_repeats": math.sqrt(0.5)}
    tail = inspect.signature(m.judged).parameters["tail"].default
    assert min((most[v] / spread) ** 2 for v, spread in m.SPREAD.items()) > m.chi2_quantile(1 - tail, m.P)
