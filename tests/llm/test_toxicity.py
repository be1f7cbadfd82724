"""Segments against their definition, the fit on small tables, and held-out accuracy."""

from __future__ import annotations

import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import toxicity
from corpusloom.llm.common import read
from tests.llm.conftest import words

SF = "/root/testdata/sf0.01"


def brute_segments(scores):
    """Take the segment of greatest score (shortest, leftmost), then go on left and right of it."""
    best = None
    for a in range(len(scores)):
        total = 0.0
        for b in range(a, len(scores)):
            total += scores[b]
            key = (total, -(b - a), -a)
            if total > 1e-12 and (best is None or key > best[0]):
                best = (key, a, b, total)
    if best is None:
        return []
    _, a, b, total = best
    right = [(x + b + 1, y + b + 1, s) for x, y, s in brute_segments(scores[b + 1 :])]
    return [*brute_segments(scores[:a]), (a, b, total), *right]


@pytest.mark.parametrize("seed", range(40))
def test_segments_are_the_maximal_ones(seed):
    rng = random.Random(seed)
    # Scores of many digits leave no ties.
    scores = [rng.uniform(0.1, 6) if rng.random() < 0.3 else -1.0 for _ in range(rng.randint(0, 40))]
    places = [k for k, s in enumerate(scores) if s > 0]
    mine = toxicity.segments(places, [scores[k] for k in places])
    want = brute_segments(scores)
    assert [(a, b) for a, b, _ in mine] == [(a, b) for a, b, _ in want]
    assert np.allclose([s for *_, s in mine], [s for *_, s in want])


def test_segments_of_isolated_words_take_linear_time():
    begin = time.process_time()
    found = toxicity.segments(list(range(0, 600_000, 20)), [2.0] * 30_000)
    assert len(found) == 30_000 and all(a == b for a, b, _ in found)
    assert time.process_time() - begin < 3


def labelled(spark, n=300):
    rng = random.Random(1)
    docs, labels = [], []
    for k in range(n):
        bad = k % 4 == 0
        w = words(rng, 60, 200).split()
        for _ in range(3 if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["vile", "rotten", "nasty"]))
        docs.append((k, " ".join(w)))
        labels.append((k, int(bad)))
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learns_and_scores_every_row(spark, clashing):
    docs, labels = labelled(spark)
    docs += [(None, "vile rotten nasty"), (9001, None), (9002, ""), (9003, "!!! ???"), (9004, "Vile, ROTTEN; nasty " * 5000), docs[4], docs[5]]
    out = toxicity.judge(clashing(docs), labels).collect()
    assert len(out) == len(docs)
    by = {r.doc_id: r for r in out}
    held = [r for r in out if r.held_out]
    assert held and all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert all(r.predicted == int(r.doc_id % 4 == 0) for r in held if r.doc_id < 300)
    assert by[9001].score == by[9002].score == by[9003].score < 0.7 and by[9001].n_passages == 0
    assert by[9004].predicted == 1 and all(0 <= r.score <= 1 for r in out)


def test_labels_of_held_out_rows_change_nothing(spark, frame):
    docs, labels = labelled(spark)
    other = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out("doc_id"), 1 - labels.toxic).otherwise(labels.toxic))
    a, b = (toxicity.fit(frame(docs), x) for x in (labels, other))
    assert (a.words.hashes == b.words.hashes).all() and (a.drift, a.k, a.lam, a.intercept, a.slope) == (b.drift, b.k, b.lam, b.intercept, b.slope)


def test_copies_count_once(spark, frame):
    docs, labels = labelled(spark, 120)
    more = docs + [(500 + k, docs[0][1]) for k in range(60)]
    extra = labels.unionByName(spark.createDataFrame([(500 + k, 1) for k in range(60)], labels.schema))
    rows = toxicity.training_labels(frame(more), extra, 10_000).collect()
    assert len([r for r in rows if r.doc_id >= 500]) <= 1
    assert len(toxicity.training_labels(frame(docs), labels, 20).collect()) < 50


def test_no_labels_and_no_documents(spark, frame):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.judge(frame([(1, "a b"), (2, None)]), none).collect()
    assert len(out) == 2 and len({r.score for r in out}) == 1
    assert toxicity.judge(frame([]), none).count() == 0
    nulls = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    assert toxicity.judge(frame([(1, "a b")]), nulls).count() == 1


def test_filter_agrees_with_scores(spark, clashing):
    docs, labels = labelled(spark)
    docs += [(None, "vile rotten nasty vile rotten"), (7, docs[7][1])]
    kept = toxicity.drop_toxic(clashing(docs), labels)
    bad = toxicity.judge(clashing(docs), labels).where("predicted = 1").count()
    assert kept.columns == clashing(docs).columns and kept.count() == len(docs) - bad and bad >= 75


def test_filter_takes_long_toxic_documents(spark, frame):
    docs, labels = labelled(spark)
    docs += [(9004, "Vile, ROTTEN; nasty " * 5000)]
    kept = {r.doc_id for r in toxicity.drop_toxic(frame(docs), labels).collect()}
    assert kept == {r.doc_id for r in toxicity.judge(frame(docs), labels).where("predicted = 0").collect()} and 9004 not in kept


def test_held_out_accuracy(spark):
    labels = read(spark, SF, "labels")
    out = toxicity.judge(read(spark, SF, "documents"), labels).join(labels, "doc_id").where("held_out").toPandas()
    rank, y = out.score.rank(), out.toxic
    n1 = y.sum()
    auc = (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))
    assert auc > 0.8 and ((out.predicted == 1) & (y == 0)).sum() <= 2


def test_counts_of_candidates(spark, frame):
    rng = random.Random(1)
    rows = [(k, words(rng, rng.randint(0, 30), 20)) for k in range(50)] + [(50, None), (51, ""), (52, "w1 w1 W1")]
    known, _ = toxicity.plain_words(pa.array([" ".join(f"w{k}" for k in range(25))]))
    names = dict(zip(known.tolist(), range(25)))
    # Others between them, so that there are several blocks.
    hashes = np.unique(np.r_[known, np.random.default_rng(1).integers(0, 1 << 63, 3 * toxicity.BLOCK).astype(np.uint64) * np.uint64(2)])
    found, n_words = toxicity.count_everywhere(frame(rows).repartition(5), hashes)
    want = [sum(f"w{names[h]}" in (t or "").lower().split() for _, t in rows) if h in names else 0 for h in hashes.tolist()]
    assert n_words == sum(len((t or "").split()) for _, t in rows) and found.tolist() == want and sum(want) > 200
    assert toxicity.count_everywhere(frame([]), hashes[:0])[0].tolist() == []
