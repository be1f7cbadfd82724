from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import line_quality as L
from corpusloom.llm.queries import QUERIES
from tests.llm.conftest import words

SF = "/root/testdata/sf0.01"


def random_lines(seed: int, sizes: list[int]):
    rng = np.random.default_rng(seed)
    n = sum(sizes)
    return rng.integers(0, L.BINS, (n, len(L.FEATURES))).astype(np.uint8), np.cumsum([0, *sizes]), rng.normal(0, 0.4, L.N_WEIGHTS)


def test_forward_backward_equals_enumeration():
    bins, first, weights = random_lines(1, [1, 4, 3, 1, 6])
    odds, _ = L.potentials(bins, first, weights)
    pairs = weights[3 * L.SIDE :].reshape(2, 2)
    good, log_z, expected = L.forward_backward(odds, first, pairs)
    want_z, want_pairs, want_good = 0.0, np.zeros((2, 2)), []
    for a, b in zip(first[:-1], first[1:]):
        paths = list(itertools.product((0, 1), repeat=b - a))
        score = [sum(odds[a + k] for k, y in enumerate(p) if y) + sum(pairs[x, y] for x, y in zip(p, p[1:])) for p in paths]
        z = np.logaddexp.reduce(score)
        prob = np.exp(np.array(score) - z)
        want_z += z
        want_good += [sum(q for p, q in zip(paths, prob) if p[k]) for k in range(b - a)]
        for p, q in zip(paths, prob):
            for x, y in zip(p, p[1:]):
                want_pairs[x, y] += q
    assert good == pytest.approx(want_good) and log_z == pytest.approx(want_z) and expected == pytest.approx(want_pairs)


def test_gradient_equals_differences():
    bins, first, weights = random_lines(2, [3, 1, 5])
    label = np.array([1, 0, 1])
    _, gradient = L.loss_of(bins, first, label, weights)
    for k in [*np.flatnonzero(gradient)[:40], *range(3 * L.SIDE, L.N_WEIGHTS)]:
        step = np.zeros(L.N_WEIGHTS)
        step[k] = 1e-5
        d = (L.loss_of(bins, first, label, weights + step)[0] - L.loss_of(bins, first, label, weights - step)[0]) / 2e-5
        assert gradient[k] == pytest.approx(d, abs=1e-5)


def test_extreme_potentials_stay_finite():
    good, log_z, _ = L.forward_backward(np.array([900.0, -900.0, 900.0]), np.array([0, 3]), np.array([[300.0, -300.0], [-300.0, 300.0]]))
    assert np.isfinite(good).all() and np.isfinite(log_z)


def test_minimize_finds_the_minimum():
    a = np.diag(np.arange(1.0, 21.0))
    x = L.minimize(lambda x: (0.5 * x @ a @ x - x.sum(), a @ x - 1), np.zeros(20), 200)
    assert x == pytest.approx(1 / np.arange(1.0, 21.0), abs=0.03)


def plain_features(text: str | None) -> list[dict]:
    out = []
    seen = set()
    for line in (text or "").split("\n"):
        w = line.split(" ")
        w = [x for x in w if x]
        out.append({
            "characters": len(line), "words": len(w), "distinct": len(set(w)), "repeated": sum(x == y for x, y in zip(w, w[1:])),
            "copied": line in seen and bool(w), "single": sum(len(x.encode()) == 1 for x in w),
        })
        seen.add(line)
    return out


def test_line_features_equal_a_plain_count():
    rng = random.Random(4)
    texts = [None, "", "\n", "a", "a\n", "\n\nb b b\nb b b\n", "é è é\nÀ a", *("\n".join(words(rng, rng.randint(0, 9), 4) for _ in range(rng.randint(0, 9))) for _ in range(30))]
    bins, weight, first = L.line_features(pa.array(texts))
    want = [plain_features(t) for t in texts]
    assert np.diff(first).tolist() == [len(w) for w in want]
    got = {f: bins[:, k].tolist() for k, f in enumerate(L.FEATURES)}
    rows = [r for w in want for r in w]
    assert weight.tolist() == [max(r["characters"], 1) for r in rows]
    for f in ("characters", "words"):
        assert got[f] == L.log_bins(np.array([r[f] for r in rows])).tolist()
    for f in ("distinct", "repeated", "single"):
        assert got[f] == L.bins_of(np.array([r[f] / max(r["words"], 1) for r in rows])).tolist(), f
    assert got["copied"] == [int(r["copied"]) for r in rows]


@pytest.fixture(scope="module")
def training(spark):
    rng = random.Random(9)
    docs, labels = [], []
    for k in range(240):
        bad = k % 4 == 0
        lines = [words(rng, rng.randint(4, 12), 400).capitalize() + "." for _ in range(rng.randint(2, 8))]
        if bad:
            at = rng.randrange(len(lines))
            lines[at:] = [" ".join(w.upper() + "!!" for w in line.split()) for line in lines[at:]]
        docs.append((k, "\n".join(lines)))
        labels.append((k, int(not bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_lines_of_a_document_are_told_apart(spark, training, frame):
    model = L.fit(*training)
    rows = L.score(frame([(1, "Plain words stand here.\n" * 6 + "Last plain line."), (2, "SHOUT!! SHOUT!! AGAIN!!\n" * 5 + "NOW!!")]), model).collect()
    found = {r["doc_id"]: r for r in rows}
    assert found[1]["score"] > 0.9 and found[1]["bad_lines"] == [] and found[2]["score"] < 0.1 and found[2]["bad_lines"] == [0, 1, 2, 3, 4, 5]


def test_odd_documents(spark, training, clashing):
    model = L.fit(*training)
    rows = [(1, None), (2, ""), (3, "\n\n\n"), (4, "One line. " * 20_000), (5, "Line.\n" * 30_000), (6, "Same."), (6, "Same."), (None, "x")]
    got = L.score(clashing(rows), model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    one = {r["doc_id"]: r["score"] for r in got}
    assert one[1] == one[2] and len({r["score"] for r in got if r["doc_id"] == 6}) == 1
    assert next(r["n_lines"] for r in got if r["doc_id"] == 5) == 30_001


def test_empty_tables_and_one_kind_of_label(spark, training, frame):
    docs, labels = training
    assert L.judge(frame([]), labels).count() == 0
    assert {r["score"] for r in L.judge(docs, labels.where("false")).collect()} == {0.5}
    only = L.judge(docs, labels.where("quality = 1")).collect()
    assert len({r["score"] for r in only}) == 1 and only[0]["predicted"] == 1


def test_held_out_labels_change_nothing(spark, training):
    docs, labels = training
    flipped = labels.withColumn("quality", L.F.when(L.held_out("doc_id"), 1 - L.F.col("quality")).otherwise(L.F.col("quality")))
    score = [{r["doc_id"]: r["score"] for r in L.judge(docs, x).collect()} for x in (labels, flipped)]
    assert score[0] == pytest.approx(score[1], abs=1e-6)


def test_held_out_documents_of_the_table(spark):
    rows = QUERIES["op12_line_quality"](spark, SF).where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    wrong = [r["doc_id"] for r in rows if r["predicted"] != r["quality"]]
    assert len(rows) > 100 and len(wrong) <= 0.02 * len(rows)
