import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from staylift.llm import merkle_manifest as mm
from staylift.llm.queries import op11_merkle_manifest

COLUMNS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def climb(digests, arity):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][k : k + arity]) for k in range(0, len(levels[-1]), arity)])
    return levels


def plain(rows, arity=2, changed=lambda row: None):
    """Trees built whole, level by level."""
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(*row), row))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    levels = {n: climb([x[2] for x in sorted(trees[n], key=lambda x: x[:3])], arity) for n in names}
    upper = climb([levels[n][-1][0] for n in names], arity)
    found = []
    for rank, n in enumerate(names):
        for k, (_, _, digest, row) in enumerate(sorted(trees[n], key=lambda x: x[:3])):
            other = changed(row)
            now, beside = leaf(*other) if other else digest, []
            for tree, place in ((levels[n], k), (upper, rank)):
                for level in tree[:-1]:
                    start = place - place % arity
                    run = level[start : start + arity]
                    at = place - start
                    beside.append("".join(run[:at] + run[at + 1 :]))
                    now = H(*run[:at], now, *run[at + 1 :])
                    place //= arity
            found.append((row[0], digest, levels[n][-1][0], upper[-1][0], H(*beside), now))
    return sorted(found, key=str)


def made(spark, rows, arity=2, height=2, tampered=None, change=None):
    docs = spark.createDataFrame(rows, COLUMNS)
    out = mm.manifest(docs, tampered, change, arity, height)
    proof = F.sha2(F.array_join("siblings", "").cast("binary"), 256).alias("proof")
    return out, sorted((tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", proof, "folded_root").collect()), key=str)


def rows_of(n, langs=("de", "en", "é", None)):
    return [(i, f"text {i} ü", langs[0] if i % 3 else langs[i % len(langs)], "a" if i % 2 else None, i * 3) for i in range(n)]


@pytest.mark.parametrize(("n", "arity", "height"), [(1, 2, 2), (2, 2, 1), (4, 2, 2), (5, 2, 2), (16, 2, 2), (17, 2, 2), (64, 2, 2), (65, 2, 2), (83, 2, 3), (50, 3, 1), (90, 3, 2), (130, 2, 10)])
def test_trees_equal_those_built_whole(spark, n, arity, height):
    rows = rows_of(n)
    tampered = F.col("doc_id") % 3 == 1
    _, found = made(spark, rows, arity, height, tampered, {"n_chars": F.col("n_chars") + 1})
    assert found == plain(rows, arity, lambda r: (*r[:4], r[4] + 1) if r[0] % 3 == 1 else None)


@pytest.mark.parametrize("langs", [("en",), ("en", "de"), tuple(f"l{i:02}" for i in range(9))])
def test_one_language_and_many(spark, langs):
    rows = [(i, "t", langs[i % len(langs)], "s", 1) for i in range(40)]
    assert made(spark, rows)[1] == plain(rows)


def test_a_version_copies_its_way_and_nothing_else(spark):
    rows = [(i, "t", "en", "s", i) for i in range(37)]
    out, _ = made(spark, rows, 2, 2, F.col("doc_id") == 20, {"text": F.lit("other")})
    told = {r.doc_id: r for r in out.collect()}
    version = told[20].copied
    assert len(version) == 1 + 6 and version[-1] == told[20].folded_root != told[20].root
    assert version[0] == leaf(20, "other", "en", "s", 20)
    assert all(r.copied is None and r.folded_root == r.root for k, r in told.items() if k != 20)
    # The version's nodes are those of a tree built with the changed row.
    whole = climb([leaf(*(r if r[0] != 20 else (20, "other", "en", "s", 20))) for r in rows], 2)
    assert version == [level[20 >> k] for k, level in enumerate(whole)]


def test_copied_nodes_share_the_others():
    levels = mm.block_levels([H(str(i)) for i in range(8)], True, 2, 3)
    old = levels[-1][0]
    path = mm.copied_path(old, 5, 3, 2, H("new"))
    assert [n.digest for n in path[:1]] == [H("new")]
    new = path[-1]
    assert new.children[0] is old.children[0]
    assert new.children[1].children[1] is old.children[1].children[1]
    assert new.children[1].children[0].children[0] is old.children[1].children[0].children[0]
    assert old.digest == climb([H(str(i)) for i in range(8)], 2)[-1][0]


def test_nulls_repeats_clashing_columns_and_no_rows(spark):
    rows = [(None, None, None, None, None), (None, "", "", "", 0), (7, "x" * 300_000, "en", "s", None), (7, "x", "en", "s", 1), (7, "x", "en", "s", 1), (3, "-", None, None, 2)]
    assert made(spark, rows, 2, 1)[1] == plain(rows)
    out, found = made(spark, rows, 2, 1, F.col("n_chars") > 0, {"n_chars": F.col("n_chars") + 1})
    assert found == plain(rows, 2, lambda r: (*r[:4], r[4] + 1) if r[4] else None)
    extra = spark.createDataFrame(rows, COLUMNS).withColumns({c: F.lit(1) for c in ("tree", "place", "digest", "block", "root", "leaf", "tampered")})
    assert mm.manifest(extra, height=1).count() == 6
    assert made(spark, [])[1] == []


def test_the_query_equals_a_plain_tree(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = op11_merkle_manifest(spark, sf).collect()
    bad = {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 7 == 0}
    assert bad and {r.doc_id for r in found if not r.verified} == bad
    told = sorted((tuple(r)[:6] for r in found), key=str)
    assert told == plain(rows, 2, lambda r: (*r[:4], r[4] + 1) if r[0] in bad else None)
