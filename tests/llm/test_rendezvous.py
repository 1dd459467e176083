from __future__ import annotations

import hashlib
import math
import zlib

from staylift.llm import rendezvous

SCHEMA = "doc_id LONG, text STRING, shard STRING, record STRING, size INT"


def place(key, weights) -> int:
    def score(shard):
        drawn = (int(hashlib.md5(f"{shard}:{'' if key is None else key}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        return -weights[shard] / math.log(drawn), -shard

    return max(range(len(weights)), key=score)


def test_table_as_brute_force(spark):
    rows = [(i, "é" * (i % 7), "s", "r", 1) for i in range(400)] + [(None, None, None, None, None), (7, "dup", "", "", 0), (7, "dup", "", "", 0)]
    got = rendezvous.shard_table(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == sorted(
        (i or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows
    )
    for r in got:
        assert r.shard == place(r.doc_id, [1.0] * 8) and r.grown_shard == place(r.doc_id, [1.0] * 9)
        assert r.grown_shard in (r.shard, 8)
    for shard in range(8):
        own = sorted((r for r in got if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        assert [r.doc_id or -1 for r in own] == sorted(r.doc_id or -1 for r in own)


def test_weights_share_the_keys(spark):
    rows = [(i, "", "", "", 0) for i in range(4000)]
    placed = rendezvous.with_shards(spark.createDataFrame(rows, SCHEMA), [1.0, 3.0])
    counts = {r["shard"]: r["count"] for r in placed.groupBy("shard").count().collect()}
    assert abs(counts[1] / 4000 - 0.75) < 0.03


def test_empty_table(spark):
    assert rendezvous.shard_table(spark.createDataFrame([], SCHEMA)).collect() == []
