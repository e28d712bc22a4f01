"""The pipeline's stages, each judged on its own input by brute force."""

from __future__ import annotations

import pytest

import corpus_pipeline
from pensio.llm import pii
from pensio.llm.common import stage
from pensio.llm.decontaminate import split_item
from tests.llm.test_text import plain, reach

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """(input, output) of each stage by name."""
    docs, out = spark.read.parquet(f"{DATA}/documents.parquet"), {}
    for name, step in corpus_pipeline.STAGES:
        after = stage(step(spark, docs, DATA))
        out[name] = docs, after
        docs = after
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_are_those_of_documents(steps):
    for name in list(steps)[:-1]:
        before, after = steps[name]
        assert after.dtypes == before.dtypes


def test_junk_goes_and_good_documents_stay(spark, steps):
    before, after = map(texts, steps["quality"])
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    wrong = [d for d in before if d in quality and (d in after) != (quality[d] == 1)]
    assert len(wrong) <= 0.03 * len(quality)


def test_one_document_of_each_group_stays(steps):
    before, after = map(texts, steps["near_duplicates"])
    sets = {d: plain(t, 5) for d, t in before.items()}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    low = reach(links)
    assert set(after) == {d for d in before if low.get(d, d) == d}


def test_no_document_holds_a_test_item(spark, steps):
    before, after = map(texts, steps["decontamination"])
    gone = set()
    for item in spark.read.parquet(f"{DATA}/benchmark.parquet").collect():
        share = plain(item.text, 5)
        answer = plain(split_item(item.text)[1], 1)
        for d, t in before.items():
            if len(share & plain(t, 5)) >= 0.8 * len(share) and len(answer & plain(t, 1)) >= 0.5 * len(answer):
                gone.add(d)
    assert set(before) - set(after) == gone


def test_personal_data_is_replaced(steps):
    before, after = map(texts, steps["personal_data"])
    assert set(before) == set(after)
    for d, t in before.items():
        spans = pii.base_spans(t)
        assert not pii.base_spans(after[d])
        assert (after[d] == t) or spans or "<" in after[d]


def test_all_that_is_left_is_packed(steps):
    before, after = steps["packing"]
    rows = after.collect()
    assert {r.doc_id for r in rows} == set(texts(before))
    fill = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 4096


def test_run_is_the_stages_one_after_the_other(spark, steps):
    assert corpus_pipeline.run(spark, DATA).count() == steps["packing"][1].count()
