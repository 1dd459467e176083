from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylift.llm import toxicity_gru as t
from staylift.llm.queries import QUERIES

TEXTS = ["", " ", "One, two;\tthree", "École ÉCOLE!!\n\nok", "...", "a", "x" * 40 + " y", None and "", "word " * 200, "idiot."]
TEXTS = [x for x in TEXTS if x is not None]


def plain_words(text: str) -> list[bytes]:
    kept = re.sub(rb"[!-/:-@\[-`{-~]", b"", text.encode()).lower()
    return kept.split()


def test_words_as_brute_force():
    words = t.Words([x.encode() for x in TEXTS])
    expected = [(k, w) for k, x in enumerate(TEXTS) for w in plain_words(x)]
    assert words.owner.tolist() == [k for k, _ in expected]
    by_hash: dict = {}
    for h, (_, w) in zip(words.hashes.tolist(), expected, strict=True):
        by_hash.setdefault(h, set()).add(w)
    assert all(len(x) == 1 for x in by_hash.values()) and len(by_hash) == len({w for _, w in expected})
    for length in t.GRAMS:
        hashes, owners = words.grams(length)
        grams = [(k, (b"\1" + w + b"\1")[i : i + length]) for k, (_, w) in enumerate(expected) for i in range(len(w) + 3 - length)]
        assert owners.tolist() == [k for k, _ in grams]
        kinds = {}
        for h, (_, g) in zip(hashes.tolist(), grams, strict=True):
            assert kinds.setdefault(h, g) == g
        assert len(kinds) == len({g for _, g in grams})


def test_windows_overlap_and_cover():
    sizes = [0, 1, t.WINDOW, t.WINDOW + 1, 1000]
    owners = np.repeat(np.arange(len(sizes)), sizes)
    first, count, text = t._windows(owners, len(sizes))
    at = np.cumsum(sizes) - sizes
    for k, n in enumerate(sizes):
        own = [(f - at[k], c) for f, c, x in zip(first, count, text, strict=True) if x == k]
        assert {w for f, c in own for w in range(f, f + c)} == set(range(n))
        assert all(c == min(n, t.WINDOW) for _, c in own)
        assert all(b[0] - a[0] <= t.STRIDE for a, b in zip(own, own[1:], strict=False))


def small_model(seed: int = 1) -> t.Model:
    r = random.Random(seed)
    bad, good = ["badword", "nasty", "scumlike", "verb"], ["fine", "good", "day", "plain", "thing", "here"]
    texts = []
    for k in range(120):
        words = r.choices(good, k=r.randrange(4, 80)) + [f"own{k}x{i}" for i in range(8)] + (r.choices(bad, k=3) if k % 2 else [])
        r.shuffle(words)
        texts.append(" ".join(words))
    return t.train(texts, [k % 2 for k in range(120)], epochs=8, batch=16)


@pytest.mark.parametrize("name", ["word", "gram", "Wwf", "Wgb", "Uf", "Ub", "bf", "A", "a", "v", "c"])
def test_gradients_by_differences(name):
    r = np.random.default_rng(5)
    p = {k: v.astype(np.float64) for k, v in small_model().weights.items()}
    word, gram = r.integers(0, len(p["word"]), (6, 4)), r.integers(0, len(p["gram"]), (6, 4))
    mask = (np.arange(6)[:, None] < np.array([6, 1, 3, 5])[None, :]).astype(np.float64)
    y = np.array([1.0, 0, 1, 0])

    def loss() -> float:
        z = t._forward(p, word, gram, mask)[0]
        return float((np.logaddexp(0, z) - y * z).sum())

    logit, cache = t._forward(p, word, gram, mask, keep=True)
    grad = t._backward(p, word, gram, mask, cache, t._sigmoid(logit) - y)[name]
    flat = p[name].reshape(-1)
    for k in r.choice(len(flat), min(6, len(flat)), replace=False):
        old, step = flat[k], 1e-3
        flat[k] = old + step
        up = loss()
        flat[k] = old - step
        down = loss()
        flat[k] = old
        assert abs((up - down) / (2 * step) - grad.reshape(-1)[k]) < 2e-3 * max(1, abs(grad.reshape(-1)[k]))


def test_scores_do_not_depend_on_company():
    model = small_model()
    r = random.Random(2)
    texts = [*TEXTS, *[" ".join(r.choice(["badword", "fine", "scumlike", "day", "x1"]) for _ in range(r.randrange(1, 300))) for _ in range(20)]]
    together = t.scores(model, texts)
    alone = np.array([t.scores(model, [x])[0] for x in texts])
    assert np.allclose(together, alone, atol=1e-5) and ((0 <= together) & (together <= 1)).all()
    assert t.scores(model, [None])[0] == t.scores(model, [""])[0]


def test_a_bad_word_anywhere_in_a_long_text():
    model = small_model()
    clean = "fine words good day here plain thing " * 400
    for at in (0, 7_000, len(clean)):
        assert t.scores(model, [clean[:at] + " nasty badword scumlike verb " + clean[at:]])[0] > 0.7 > 0.5 > t.scores(model, [clean])[0]


def test_held_out_by_checksum(spark):
    ids = spark.range(50).select(F.col("id").alias("doc_id"), t.held_out(F.col("id")).alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in ids)


def test_query_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op7_toxicity_gru"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    got = rows.filter("held_out").join(labels, "doc_id").select("toxic", "predicted").collect()
    toxic, clean = [r.predicted for r in got if r.toxic], [r.predicted for r in got if not r.toxic]
    assert sum(toxic) / len(toxic) > 0.75 and sum(clean) / len(clean) < 0.06
    assert rows.count() == 1000


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(k, ("nasty badword " if k % 2 else "fine day ") * 3 + str(k), "t", 0.5, "s") for k in range(120)]
    docs = spark.createDataFrame([*rows, (None, None, None, None, None), (3, "nasty badword", "", 0.0, ""), (4, "", "", 0.0, "")], "doc_id LONG, text STRING, toxic STRING, score DOUBLE, text_hash STRING")
    labels = spark.createDataFrame([*((k, k % 2) for k in range(120)), (None, 1), (5, None), (6, 1), (6, 1)], "doc_id LONG, toxic INT")
    model = t.fitted(docs, labels, sample=50)
    got = t.scored(docs.repartition(4), model).collect()
    assert len(got) == 123 and all(0 <= r.score <= 1 for r in got)
    unlabelled = t.fitted(docs, labels.limit(0))
    assert all(r.score < 0.1 for r in t.scored(docs, unlabelled).collect())
    empty = docs.limit(0)
    assert t.scored(empty, t.fitted(empty, labels.limit(0))).collect() == []
