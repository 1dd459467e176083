from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from staylift.llm import exact_dedup

SCHEMA = "doc_id LONG, text STRING, digest STRING, norm STRING, salt INT, keep_id LONG"
ROWS = [
    (1, "Same text", "a", "b", 1, 1), (5, "sAME TEXT", "a", "b", 1, 1), (3, "same text ", None, None, None, None),
    (7, None, "x", "y", 2, 2), (8, "", "x", "y", 2, 2), (None, "", "x", "y", 2, 2), (9, "École", "d", "n", 0, 0),
    (10, "éCOLE", "d", "n", 0, 0), (11, "École", "d", "n", 0, 0), (12, "Ecole", None, "n", 0, 0), (13, "x" * 300_000, "", "", 0, 0),
    (5, "same text", "other", "row", 0, 0), (5, "same text", "other", "row", 0, 0), (None, None, None, None, None, None),
]


def lowered(text: str | None) -> str:
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def expected(rows) -> list:
    groups: dict[str, list] = {}
    for row in rows:
        groups.setdefault(lowered(row[1]), []).append(row[0])
    out = []
    for norm, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(norm.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def marked(df, **options) -> list:
    return sorted((tuple(r) for r in exact_dedup.mark_copies(df, **options).collect()), key=str)


def weak(norm):
    return (F.length(norm) % 3).cast("string")


def test_marks_as_brute_force(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    assert marked(docs) == expected(ROWS)
    assert marked(docs, salts=1) == expected(ROWS)


def test_content_decides_when_digests_clash(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    found = [(i, k, n, kept) for i, k, n, kept, _ in marked(docs, digest=weak)]
    assert found == sorted(((i, k, n, kept) for i, k, n, kept, _ in expected(ROWS)), key=str)


def test_one_row_stays_with_all_its_columns(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    for options in ({}, {"digest": weak}):
        kept = exact_dedup.drop_copies(docs, **options)
        assert kept.columns == docs.columns
        texts = sorted((lowered(r.text), r.doc_id) for r in kept.collect())
        assert texts == sorted({(lowered(r[1]), r2) for r in ROWS for r2 in [max(x[0] or -1 for x in ROWS if lowered(x[1]) == lowered(r[1]))]})


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert marked(docs) == [] and exact_dedup.drop_copies(docs).collect() == []


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_copies_combine_before_they_are_shuffled(spark, monkeypatch):
    rows = [(i, "hot" if i % 2 else f"text {i % 40}" if i % 4 else f"alone {i}", *[None] * 4) for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(8, "doc_id")
    plans, read, real = [], [], exact_dedup.checkpointed

    def watched(df):
        plans.append(plan_of(df))
        return real(df)

    monkeypatch.setattr(exact_dedup, "checkpointed", watched)
    aggregated = exact_dedup.copy_groups
    monkeypatch.setattr(exact_dedup, "copy_groups", lambda rows: read.append(rows) or aggregated(rows))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = exact_dedup.mark_copies(docs)
        joined = plan_of(found)
        assert sorted((tuple(r) for r in found.collect()), key=str) == expected(rows)
        dropped = exact_dedup.drop_copies(docs)
        assert sorted(r.text for r in dropped.collect()) == sorted({r[1] for r in rows})
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Texts of single digests, but for a few, are not among those compared; a hot digest has many salts.
    assert {r.text for r in read[0].collect()} >= {"hot"} and read[0].filter("text LIKE 'alone%'").count() < 5
    assert read[0].filter("text = 'hot'").select("salt").distinct().count() > 1
    # A partial aggregate on digest, salt and content lies below the first exchange of texts.
    groups = next(p for p in plans if "partial_max(doc_id" in p)
    lines = groups.splitlines()
    last = max(k for k, line in enumerate(lines) if "Exchange hashpartitioning" in line and "norm" in line and "salt" in line)
    below = next(line for line in lines[last + 1 :] if "Aggregate" in line)
    assert "partial_max" in below and all(name in below for name in ("digest#", "salt#", "norm#"))
    # Rows meet their groups by digest and salt.
    assert any("Join" in line and "digest#" in line and "salt#" in line for line in joined.splitlines())


def test_rows_that_tie_are_told_apart_by_their_other_columns(spark):
    docs = spark.createDataFrame([(1, "Same", 1), (1, "same", 3), (1, "SAME", 2), (2, "x", 5), (2, "x", 4)], "doc_id LONG, text STRING, mark INT")
    for n in (1, 5):
        kept = exact_dedup.drop_copies(docs.repartition(n)).collect()
        assert sorted((r.doc_id, r.mark) for r in kept) == [(1, 3), (2, 5)]
    bare = exact_dedup.drop_copies(docs.select("doc_id", "text")).collect()
    assert sorted(r.doc_id for r in bare) == [1, 2]


def python_in_a_row(df) -> int:
    """The most Python steps that one path of the plan has: as many workers each of its tasks holds."""
    most, path = 0, []
    for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        path = [step for step in path if step[0] < depth]
        path.append((depth, line.lstrip(" :+-").startswith("ArrowEvalPython")))
        most = max(most, sum(python for _, python in path))
    return most


def test_a_task_has_one_python_worker(spark, monkeypatch):
    stored, plans = exact_dedup.checkpointed, []
    monkeypatch.setattr(exact_dedup, "checkpointed", lambda df: plans.append(python_in_a_row(df)) or stored(df))
    df = spark.createDataFrame(ROWS, SCHEMA)
    exact_dedup.mark_copies(df).collect()
    plans.append(python_in_a_row(exact_dedup.drop_copies(df)))
    assert max(plans) == 1
