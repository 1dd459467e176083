from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from staylift.llm import block_mixing, cost_packing, toxicity_gru
from staylift.llm.queries import documents
from tests.llm.test_gray_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def lowered(text: str | None) -> str:
    return "".join(c.lower() if c.isascii() else c for c in text or "")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Every stage's result, each stage reading what the one before wrote."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), documents(spark, SF), [documents(spark, SF)]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs)
    return out


def test_columns(stored):
    for table in stored[:-1]:
        assert table.dtypes == stored[0].dtypes


def test_toxic_documents_go(spark, stored):
    model = toxicity_gru.fitted(stored[0], spark.read.parquet(f"{SF}/labels.parquet"))
    rows = stored[0].collect()
    scores = toxicity_gru.scores(model, [r.text for r in rows])
    sure = {r.doc_id for r, s in zip(rows, scores, strict=True) if abs(s - 0.7) > 1e-4}
    kept = {r.doc_id for r in stored[1].collect()}
    assert kept & sure == {r.doc_id for r, s in zip(rows, scores, strict=True) if s < 0.7} & sure


def test_one_of_equal_texts_stays(stored):
    last: dict = {}
    for r in stored[1].collect():
        last[lowered(r.text)] = max(r.doc_id, last.get(lowered(r.text), r.doc_id))
    assert sorted(r.doc_id for r in stored[2].collect()) == sorted(last.values())


def test_one_of_linked_fingerprints_stays(stored):
    rows = stored[2].collect()
    roots = plain_components([plain_fingerprint(r.text) for r in rows], 2)
    first: dict = {}
    for r, root in zip(rows, roots, strict=True):
        first[root] = min(r.doc_id, first.get(root, r.doc_id))
    assert sorted(r.doc_id for r in stored[3].collect()) == sorted(first.values())


def test_the_mix_takes_what_it_says(stored):
    taken: Counter = Counter()
    for r in stored[4].collect():
        taken[r.doc_id] += len(r.text.split())
    assert dict(+taken) == {r.doc_id: r.taken for r in block_mixing.taken_words(stored[3], block_words=64).collect() if r.taken}


def test_every_token_is_packed(stored):
    encode = cost_packing.byte_bpe()()
    expected: Counter = Counter()
    for r in stored[4].collect():
        expected[r.doc_id] += len(encode(r.text)) + 1
    got: Counter = Counter()
    for r in stored[5].collect():
        assert len(r.ids) == 4 * r.length
        got[r.doc_id] += r.length
    assert got == expected
    fill = stored[5].groupBy("sequence_id").sum("length").collect()
    assert max(x[1] for x in fill) <= 1024 and len(fill) == -(-sum(expected.values()) // 1024)


def test_run(spark, stored):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == stored[5].columns and rows.count() == stored[5].count()


def test_stages_on_empty_tables(spark):
    docs = documents(spark, SF).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []
