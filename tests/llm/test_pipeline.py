"""The pipeline stage by stage on the smallest tables."""

from __future__ import annotations

import pytest

import corpus_pipeline
from corpusloom.llm import decontaminate, packing, privacy, toxicity
from corpusloom.llm.common import read
from tests.llm.test_packing import check
from tests.llm.test_privacy import brute as personal
from tests.llm.test_similar import brute as near

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    out, docs = [], read(spark, SF, "documents")
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[:5])


def test_toxicity_drops_what_it_scores(spark, stages):
    judged = toxicity.judge(stages[0], read(spark, SF, "labels"))
    keep = {r.doc_id for r in judged.where("predicted = 0").collect()}
    assert {i for i, _ in pairs(stages[1])} == keep


def test_one_of_each_class_stays(stages):
    rows = pairs(stages[1])
    assert {i for i, _ in pairs(stages[2])} == {c for _, c, _, _ in near(rows)}


def test_no_item_is_left(spark, stages):
    items = [(r.item_id, r.text.lower().split()) for r in read(spark, SF, "benchmark").collect()]
    before, after = dict(pairs(stages[2])), dict(pairs(stages[3]))
    gone = set()
    for i, t in before.items():
        joined = " ".join(t.lower().split())
        gone |= {i for _, w in items if " ".join(w) in joined}
    found = {r.doc_id for r in decontaminate.contaminated(stages[2], read(spark, SF, "benchmark")).collect()}
    assert gone <= found == set(before) - set(after)


def test_personal_data_is_replaced(stages):
    before, after = dict(pairs(stages[3])), dict(pairs(stages[4]))
    assert set(before) == set(after)
    for i, t in before.items():
        spans, _ = privacy.base_spans(t)
        assert not [s for s in personal(after[i]) if s[1] in (0, 3)] and (spans or "<" in after[i] or after[i] == t)
    lengths = {r.doc_id: r.n_chars for r in stages[4].collect()}
    assert all(lengths[i] == len(t) for i, t in after.items())


def test_packing_round_trip(stages):
    n, least = check(pairs(stages[4]), stages[5].collect(), packing.CAPACITY)
    assert n <= least + 2


def test_run_gives_the_same(spark, stages):
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, stages[5].collect()))
