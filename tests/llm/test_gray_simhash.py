from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from staylift.llm import gray_simhash as g

SCHEMA = "doc_id LONG, text STRING, fp LONG, u STRING, text_hash INT, node INT, root INT"


def plain_fingerprint(text: str | None) -> int:
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps: list[int], radius: int) -> list[int]:
    """For each place the smallest place it reaches."""
    root = list(range(len(fps)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [top(i) for i in range(len(fps))]


def some_fingerprints(seed: int, n: int, clusters: int) -> list[int]:
    r = random.Random(seed)
    centres = [r.getrandbits(64) for _ in range(clusters)]
    out = set(centres)
    while len(out) < n:
        fp = r.choice(centres) if r.random() < 0.7 else r.getrandbits(64)
        for _ in range(r.randrange(5)):
            fp ^= 1 << r.randrange(64)
        out.add(fp)
    return sorted(out)


def signed(fp: int) -> int:
    return fp - (1 << 64) if fp >> 63 else fp


@pytest.mark.parametrize(("na", "nb"), [(1, 1), (9, 700), (64, 65), (513, 2)])
def test_pairs_of_two_leaves(na, nb):
    fps = np.array(some_fingerprints(na * 1000 + nb, na + nb, 12), np.uint64)
    np.random.default_rng(1).shuffle(fps)
    a, b = fps[:na], fps[na:]
    for radius in (0, 2, 5):
        found = {(int(x), int(y)) for i, j in g.close_pairs(a, b, radius, False) for x, y in zip(i, j, strict=True)}
        assert found == {(i, j) for i in range(na) for j in range(nb) if (int(a[i]) ^ int(b[j])).bit_count() <= radius}
        within = {(int(x), int(y)) for i, j in g.close_pairs(b, b, radius, True) for x, y in zip(i, j, strict=True)}
        assert within == {(i, j) for j in range(nb) for i in range(j) if (int(b[i]) ^ int(b[j])).bit_count() <= radius}


def test_gray_order(spark):
    ranks = [0, 1, 2, 3, 1000, (1 << 63) - 1, 1 << 63, (1 << 64) - 1]
    rows = [(signed(r ^ (r >> 1)), r) for r in ranks]
    df = spark.createDataFrame([(fp, str(r)) for fp, r in rows], "fp LONG, r STRING")
    got = {int(x.r): x.rank for x in df.select("r", g.gray_rank(F.col("fp")).alias("rank")).collect()}
    assert all(got[r] == r - (1 << 63) for r in ranks)


@pytest.mark.parametrize(("leaf", "fanout"), [(7, 2), (16, 3), (4096, 8)])
def test_links_connect_what_is_close(spark, leaf, fanout):
    fps = some_fingerprints(leaf, 400, 25)
    links = g.linked(spark.createDataFrame([(signed(f),) for f in fps], "fp LONG").repartition(3), 2, leaf, fanout)
    pairs = links.collect()
    assert all((r.u ^ r.v) != 0 for r in pairs)
    roots = {r.node: r.root for r in g.components(links).collect()}
    mine: dict = {}
    for f in fps:
        mine.setdefault(roots.get(signed(f), signed(f)), set()).add(f)
    theirs: dict = {}
    for f, root in zip(fps, plain_components(fps, 2), strict=True):
        theirs.setdefault(root, set()).add(f)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_long_chain(spark):
    fps, at = [], 0
    for i in range(40):
        at ^= 1 << i
        fps.append(at)
    links = spark.createDataFrame([(a, b) for a, b in zip(fps, fps[1:], strict=False)], "u LONG, v LONG")
    roots = g.components(links).collect()
    assert {r.root for r in roots} == {min(fps)} and len(roots) == len(fps) - 1


def test_documents_as_brute_force(spark):
    r = random.Random(5)
    base = [" ".join(r.choice("alpha beta gamma delta École ab cd EF".split()) for _ in range(120)) for _ in range(12)]
    rows, n = [], 100
    for text in base:
        for _ in range(r.randrange(1, 6)):
            words = text.split(" ")
            words[r.randrange(len(words))] = r.choice(["x", "yy", "ÉCOLE"])
            rows.append((n, "\t".join(words), 1, "u", 1, 1, 1))
            n -= 1
    rows += [(500, None, None, None, None, None, None), (400, "", 0, "", 0, 0, 0), (None, " \n", 0, "", 0, 0, 0), (None, "lonely here", 0, "", 0, 0, 0)]
    rows += [(7000, "One two", 0, "", 0, 0, 0), (7001, "one TWO", 0, "", 0, 0, 0), (7001, "one TWO", 0, "", 0, 0, 0), (7002, "b " * 90_000, 0, "", 0, 0, 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = g.near_copies(docs, 3, 2).collect()
    fps = [plain_fingerprint(x[1]) for x in rows]
    roots = plain_components(fps, 2)
    ids: dict = {}
    for row, root in zip(rows, roots, strict=True):
        ids.setdefault(root, []).append(row[0])
    expected = [(row[0], signed(fp), min((i for i in ids[root] if i is not None), default=None)) for row, fp, root in zip(rows, fps, roots, strict=True)]
    assert sorted(((x.doc_id, x.fp, x.component_id) for x in got), key=str) == sorted(expected, key=str)
    kept = g.drop_near_copies(docs, 3, 2)
    assert kept.columns == docs.columns
    assert sorted((x.doc_id for x in kept.collect()), key=str) == sorted((min((i for i in v if i is not None), default=None) for v in ids.values()), key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert g.near_copies(docs, 3, 2).collect() == [] and g.drop_near_copies(docs, 3, 2).collect() == []


def test_clear_documents_are_not_shuffled(spark):
    """Only rows that may go are dealt anew; repeats of doc_id and text leave the one whose other columns come last."""
    rows = [(i, f"w{i} x{i} y{i} z{i} " * 4, 0) for i in range(60)] + [(100, "one two three four", 1), (101, "One two three four", 1), (101, "One two three four", 2)]
    rows += [(7, "w7 x7 y7 z7 " * 4, 5), (7, "w7 x7 y7 z7 " * 4, 9), (None, "no id at all here", 1), (None, None, 1), (200, None, 2)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, mark INT").repartition(3)
    kept = g.drop_near_copies(docs, 3, 2)
    found = {(r.doc_id, r.mark) for r in kept.collect()}
    # Texts without words link through fingerprint zero; the one with an id stays.
    assert found == {(i, 0) for i in range(60) if i != 7} | {(7, 9), (100, 1), (None, 1), (200, 2)} and kept.count() == 63
    # The first side of the union is the scan and a filter, no more.
    lines = kept._jdf.queryExecution().sparkPlan().toString().splitlines()
    at = next(k for k, line in enumerate(lines) if line.strip() == "Union")
    second = next(k for k, line in enumerate(lines) if k > at and line.startswith("+- "))
    assert second > at and not any("Aggregate" in line or "Join" in line or "Sort" in line for line in lines[at + 1 : second])
