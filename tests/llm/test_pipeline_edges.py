"""Every stage on odd documents: nulls, repeated rows, long and empty texts, further columns, no rows."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tests.llm.conftest import words

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, node string, score double, item_id long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with labels and a benchmark for the stages that read them."""
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, 1, 1), (2, 1, 0), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "one two three four five six seven eight"), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def rows():
    import random

    rng = random.Random(7)
    texts = [None, "", "  ", "x", "leak: One two three four five six seven, eight!", "mail a@b.example now", words(rng, 30_000, 5000), words(rng, 50, 900), words(rng, 50, 900)]
    out = [(k, t, None if k % 2 else "en", "s", None if t is None else len(t), "n", 0.5, 9) for k, t in enumerate(texts)]
    return [*out, out[7], (20, texts[7], None, None, None, None, None, None), (None, "no id here", "en", "s", 10, "n", 0.1, 1), (None, None, None, None, None, None, None, None)]


def test_all_stages(spark, tables):
    docs = spark.createDataFrame(rows(), COLUMNS)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.materialize(stage(spark, docs, tables), f"edge-{name}")
        assert docs.columns == columns
        if name == "near_duplicates":
            # Copies of 7 and of the texts without words go, both rows without an id stay.
            assert sorted((r.doc_id is None, r.doc_id or 0) for r in docs.collect()) == [(False, k) for k in (0, 2, 3, 4, 5, 6, 7, 8)] + [(True, 0), (True, 0)]
        if name == "decontamination":
            assert not docs.where("doc_id = 4").count() and docs.count() == 9
    assert docs.where("doc_id = 5").first().text == "mail <email> now"
    packed = corpus_pipeline.STAGES[4][1](spark, docs, tables)
    assert packed.select("doc_id").distinct().count() == 8 and packed.where("doc_id = 6").count() > 10


def test_no_documents(spark, tables):
    docs = spark.createDataFrame([], COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, tables), f"none-{name}")
        assert docs.count() == 0


def test_pipeline_takes_a_long_toxic_document(spark, tmp_path):
    docs = [(k, "vile rotten nasty words here " + str(k) if k % 4 == 0 else f"the calm text of number {k}", "en", "s", 20, "n", 0.5, 9) for k in range(200)]
    docs += [(9004, "vile rotten nasty " * 5000, "en", "s", 90_000, "n", 0.5, 9)]
    spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one two three four five six seven eight")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = spark.createDataFrame(docs, COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        left = corpus_pipeline.materialize(stage(spark, left, str(tmp_path)), f"toxic-{name}")
    ids = {r.doc_id for r in left.select("doc_id").collect()}
    assert ids and 9004 not in ids and not any(k % 4 == 0 for k in ids)
