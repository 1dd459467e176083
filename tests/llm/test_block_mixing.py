from __future__ import annotations

import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from staylift.llm import block_mixing as m

SCHEMA = "doc_id LONG, text STRING, source STRING, n_chars LONG, row STRING, rank INT, size STRING, target STRING, taken STRING, whole STRING, runs INT"
SPACE = " \t\n\x0b\x0c\r"


def words(text: str | None) -> list[str]:
    for c in SPACE[1:]:
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain_targets(sizes: dict) -> dict:
    """Share by weight, stop what is above twice its size, share the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, stopped = Fraction(3 * sum(sizes.values()), 2), set()
    while True:
        free = [s for s in order if s not in stopped]
        left = total - sum(2 * sizes[s] for s in stopped)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 2 * sizes[s]}
        if not above:
            return {s: 2 * sizes[s] if s in stopped else share[s] for s in order}
        stopped |= above


def some_rows(seed: int = 1) -> list:
    r = random.Random(seed)
    rows = []
    for i in range(400):
        source = r.choice(["a"] * 12 + ["b", "é", "\U0001f600", None, "z" * 3, ""] * 3 + ["tiny"])
        n = int(r.lognormvariate(4, 1)) if source != "tiny" else 1
        rows.append((i, r.choice([" ", "\n", " \t "]).join(f"w{i}x{k}" for k in range(n)), source, 5, *[None] * 7))
    rows += [(None, None, "a", None, *[None] * 7), (1000, "", None, 0, *[None] * 7), (1001, " \n ", "blank", 0, *[None] * 7)]
    rows += [(1002, "twice here", "b", 0, *[None] * 7)] * 2 + [(1003, "long " * 50_000, "\U0001f600", 0, *[None] * 7), (None, "no id", "a", 0, *[None] * 7)]
    return rows


def test_targets_and_taken(spark):
    rows = some_rows()
    got = m.taken_words(spark.createDataFrame(rows, SCHEMA).repartition(5), block_words=16, shard_blocks=64).collect()
    assert Counter((x.doc_id, x.size) for x in got) == Counter((row[0], len(words(row[1]))) for row in rows)
    sizes = Counter({row[2]: 0 for row in rows})
    for row in rows:
        sizes[row[2]] += len(words(row[1]))
    expected = plain_targets(sizes)
    kinds = {(sizes[s], float(t)) for s, t in expected.items()}
    assert {(x.source_size, round(x.target, 6)) for x in got} == {(s, round(t, 6)) for s, t in kinds}
    for x in got:
        assert 0 <= x.taken <= 2 * x.size
    for size, target in kinds:
        taken = sum(x.taken for x in got if x.source_size == size and abs(x.target - target) < 1e-6)
        assert abs(taken - target) <= 24, (size, target, taken)


def test_reruns_agree_whatever_the_partitions(spark):
    rows = some_rows(2)
    a = m.taken_words(spark.createDataFrame(rows, SCHEMA).repartition(3), block_words=16).collect()
    b = m.taken_words(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7), block_words=16).collect()
    assert Counter(a) == Counter(b)


@pytest.mark.parametrize("n", [1, 2, 3, 64, 1000, 4097])
def test_permutation_is_one(spark, n):
    rows = spark.range(n).select("id", F.col("id").alias("x"), F.lit(n).cast("long").alias("n"), F.lit(3).alias("k"))
    got = [r.x for r in m.permuted(rows, "x", "n", ["k"], 1).orderBy("id").collect()]
    assert sorted(got) == list(range(n))
    if n > 10:
        assert got != list(range(n)) and sum(abs(a - i) for i, a in enumerate(got)) > n * n / 5
        other = [r.x for r in m.permuted(rows.withColumn("k", F.lit(4)), "x", "n", ["k"], 1).orderBy("id").collect()]
        assert sum(a == b for a, b in zip(got, other, strict=True)) < max(10, n / 20)


def test_draws_meet_quotas_and_vary_by_shard(spark):
    quotas = [(0, 500, 800), (1, 40, 80), (2, 3000, 700), (3, 1, 0), (4, 1, 2)]
    got = m.draws(spark.createDataFrame(quotas, "rank LONG, blocks LONG, quota LONG"), 100, 5).collect()
    assert Counter(x.rank for x in got) == {r: q for r, _, q in quotas if q}
    times = Counter((x.rank, x.block) for x in got)
    for rank, blocks, quota in quotas:
        own = [times[rank, b] for b in range(blocks)]
        assert sum(own) == quota and max(own) <= -(-quota // blocks) and min(own) >= quota // blocks
    shards = Counter(x.shard for x in got)
    assert len(shards) == 16 and set(shards.values()) <= {100, 82}
    of_first = [sum(x.shard == s and x.rank == 0 for x in got) for s in range(15)]
    assert len(set(of_first)) > 4 and abs(sum(of_first) / 15 - 800 * 100 / 1582) < 8


def test_documents_of_the_mix(spark):
    rows = some_rows(3)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    out = m.mixed_documents(docs, block_words=16)
    assert out.dtypes == docs.dtypes
    taken: Counter = Counter()
    texts = {row[0]: row[1] for row in rows}
    for x in out.collect():
        taken[x.doc_id] += len(words(x.text))
        assert x.n_chars == (len(x.text) if x.text != texts[x.doc_id] else x.n_chars)
        if x.text != texts[x.doc_id] and x.doc_id is not None:
            for stretch in x.text.split("\n") if "\n" not in texts[x.doc_id] else []:
                assert stretch in texts[x.doc_id]
    expected: Counter = Counter()
    for x in m.taken_words(docs, block_words=16).collect():
        expected[x.doc_id] += x.taken
    assert +taken == +expected


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert m.taken_words(docs).collect() == [] and m.mixed_documents(docs).collect() == []


def test_equal_documents_of_several_sources_stay_apart(spark):
    """Rows that agree in doc_id and text are drawn, and come out, under their own source and other columns."""
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(30 + i)), source, i, *[None] * 7) for i in range(40) for source in ("a", "b", None)]
    rows += [(i, f"only c {i} " * 9, "c", 0, *[None] * 7) for i in range(100, 105)]
    rows += [(200, "same text and source " * 7, "a", n, *[None] * 7) for n in (1, 2, 3)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("mark", F.create_map(F.lit("n"), F.col("n_chars"))).repartition(3)
    expected: Counter = Counter()
    whole, pieces = m.mixed(docs, block_words=16)
    for x in whole.join(pieces, "row").groupBy("source").agg(F.sum("words").alias("n")).collect():
        expected[x.source] = x.n
    got: Counter = Counter()
    marks = Counter()
    for x in m.mixed_documents(docs, block_words=16).collect():
        got[x.source] += len(words(x.text))
        marks[x.doc_id, x.mark["n"]] += len(words(x.text))
    assert got == expected and set(got) == {"a", "b", "c", None}
    assert all(marks[200, n] <= 2 * 28 for n in (1, 2, 3)) and sum(marks[200, n] for n in (1, 2, 3)) > 28


def test_stretches_begin_and_end_with_words(spark):
    texts = ["  \n lead " + " \n\t ".join(f"w{i}x{k}" for k in range(200)) + " \n" for i in range(9)]
    docs = spark.createDataFrame([(i, t, "a" if i % 2 else "b", 0, *[None] * 7) for i, t in enumerate(texts)], SCHEMA)
    cut = 0
    for x in m.mixed_documents(docs, block_words=16).collect():
        if x.text != texts[x.doc_id]:
            cut += 1
            assert x.text == x.text.strip(SPACE) and not any(line == "" for line in x.text.split(" \n\t ")[0].split("\n"))
            at = -1
            for word in words(x.text):
                place = words(texts[x.doc_id]).index(word)
                assert place > at
                at = place
    assert cut
