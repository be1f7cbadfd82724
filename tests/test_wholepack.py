"""Histogram packing against best-fit decreasing over single documents."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from corpusloom.operators import wholepack

DOCS = "doc_id long, n_tokens int"


def plain_windows(lengths, window):
    """Best-fit decreasing, one document at a time: the number of windows."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(window - n)
    return len(gaps)


def check(rows, window):
    """No overlap, no gap before the last piece of a window, every piece inside of its window."""
    by = defaultdict(list)
    for sequence, offset, length in rows:
        by[sequence].append((offset, length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window
    return len(by)


@pytest.mark.parametrize("seed", range(30))
def test_plan_equals_best_fit_decreasing(seed):
    rng = random.Random(seed)
    window = rng.choice([10, 64, 100])
    lengths = [rng.randint(1, window - 1) if rng.random() < 0.5 else rng.choice([1, 3, window // 2]) for _ in range(rng.randint(0, 200))]
    count = Counter(lengths)
    rows = wholepack.plan(count, window)
    placed = [(first + k, offset, length) for length, _, n, first, offset in rows for k in range(n)]
    assert Counter(x[2] for x in placed) == count
    for length in count:
        spans = sorted((r, r + n) for x, r, n, *_ in rows if x == length)
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] == count[length]
    assert check(placed, window) == plain_windows(lengths, window)


def test_documents_that_fit_are_never_cut(spark):
    rng = random.Random(4)
    docs = [(k, int(rng.paretovariate(0.9) * 20)) for k in range(4000)] + [(9001, 0), (9002, None), (9003, 512), (9004, 1024), (9005, 5000), (9003, 512)]
    df = spark.createDataFrame(docs, DOCS).repartition(5)
    rows = wholepack.pack_whole(df, 512).collect()
    got = defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
    for k, n in docs:
        if not n:
            assert k not in got
        elif k != 9003:
            want = [(p, p * 512, min(512, n - p * 512)) for p in range(-(-n // 512))]
            assert sorted(got[k]) == want
    assert got[9003] == [(0, 0, 512)] * 2
    windows = check([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 512)
    assert sorted({r["sequence_id"] for r in rows}) == list(range(windows))
    summary = wholepack.fill(wholepack.pack_whole(df, 512), 512).first()
    assert summary["n_sequences"] == windows and summary["fill"] > 0.99


def test_empty_table_and_plan(spark):
    empty = spark.createDataFrame([], DOCS)
    assert wholepack.pack_whole(empty, 64).count() == 0 and wholepack.plan({}, 64) == []
    plan = wholepack.pack_whole(spark.createDataFrame([(1, 5)], DOCS), 64)._jdf.queryExecution().toString()
    assert "Python" not in plan.split("== Physical Plan ==")[1] and "NestedLoop" not in plan and "Cartesian" not in plan
