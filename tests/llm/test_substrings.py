"""Window removal and later-copy removal against brute force and SQL."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from corpusloom.llm import queries, repeats, substring_dedup, suffix_dedup
from corpusloom.llm.common import random_table, running, window_hash, word_hashes
from tests.llm.conftest import corpus
from tools.check import TABLES, rows_of


def brute_windows(rows, width):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    count = Counter(tuple(w[k : k + width]) for _, w in split for k in range(len(w) - width + 1))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if count[tuple(w[k : k + width])] > 1:
                gone[k : k + width] = [True] * width
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def brute_later(rows, width):
    first = defaultdict(lambda: 1 << 62)
    low = -(1 << 62)
    raw = [(i, (t or "").encode()) for i, t in rows]
    for i, b in raw:
        for k in range(len(b) - width + 1):
            first[b[k : k + width]] = min(first[b[k : k + width]], low if i is None else i)
    out = []
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - width + 1):
            if first[b[k : k + width]] < (low if i is None else i):
                gone[k : k + width] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("width", [35, 6, 1])
def test_windows_equal_brute_force(frame, seed, width):
    rows = corpus(seed)
    assert got(substring_dedup.remove_repeats(frame(rows), width)) == brute_windows(rows, width)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("width,short", [(50, 20), (12, 5)])
def test_later_copies_equal_brute_force(frame, seed, width, short):
    rows = corpus(seed) + [(None, "w1 w2 w3 " * 20), (None, None)]
    assert got(suffix_dedup.remove_later_copies(frame(rows), width, short)) == brute_later(rows, width)


def test_hot_anchors_travel_alone(frame, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_PLACES", 2)
    monkeypatch.setattr(suffix_dedup, "HOT_SHARE", 1 << 40)
    rows = corpus(3)
    assert got(suffix_dedup.remove_later_copies(frame(rows))) == brute_later(rows, 50)


def test_hot_anchors_do_not_depend_on_the_size_of_the_corpus(frame, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_PLACES", 5)
    lists, contexts = [], suffix_dedup._contexts
    monkeypatch.setattr(suffix_dedup, "_contexts", lambda w, s, n, hot: lists.append(hot) or contexts(w, s, n, hot))
    # A phrase at eight places, in a corpus of which a ten thousandth is more bytes than eight.
    around = [[" ".join(f"{k}x{j}{side}" for j in range(12)) for side in "yz"] for k in range(8)]
    rows = [(k, f"{a} a phrase that stands in all of these documents and is no secret {b}") for k, (a, b) in enumerate(around)]
    rows += [(3000, " ".join(f"{k:x}" for k in range(30_000)))]
    assert sum(len(t) for _, t in rows) > 10_000 * 9
    out = got(suffix_dedup.remove_later_copies(frame(rows)))
    assert out == brute_later(rows, 50) and len(lists[0])


def test_small_packets_and_buckets(frame, monkeypatch):
    for name, value in (("PACKET_HASHES", 50), ("PACKET_DOCS", 3), ("BUCKET_HASHES", 100), ("PART_BYTES", 500)):
        monkeypatch.setattr(repeats, name, value)
    rows = corpus(4)
    assert got(substring_dedup.remove_repeats(frame(rows), 10)) == brute_windows(rows, 10)
    assert got(suffix_dedup.remove_later_copies(frame(rows))) == brute_later(rows, 50)


def test_empty_table_and_clashing_columns(frame, clashing):
    assert got(substring_dedup.remove_repeats(frame([]))) == [] and got(suffix_dedup.remove_later_copies(frame([]))) == []
    rows = corpus(5, 10)
    assert got(substring_dedup.remove_repeats(clashing(rows), 8)) == brute_windows(rows, 8)
    assert got(suffix_dedup.remove_later_copies(clashing(rows))) == brute_later(rows, 50)


def test_one_very_long_text(frame):
    rows = [(1, "ab" * 300_000), (2, "x" + "ab" * 40)]
    out = got(suffix_dedup.remove_later_copies(frame(rows)))
    assert out == [(1, 600_000, 0, 0, hashlib.sha256(b"ab" * 300_000).hexdigest()), (2, 81, 80, 1, hashlib.sha256(b"x").hexdigest())]


def test_longest_repeats_double(frame):
    rows = [(1, " ".join(f"a{k}" for k in range(30))), (2, "z " + " ".join(f"a{k}" for k in range(30))), (3, "q " * 4)]
    assert got(substring_dedup.longest_repeats(frame(rows), 5)) == [(1, 20), (2, 20)]


def test_word_hashes_see_the_same_words():
    texts = ["  a b\tc\x0bd ", "", " x y z", "a"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.r_[0, np.cumsum([len(t.encode()) for t in texts])]
    hashes, first = word_hashes(raw, offsets)
    split = [t.encode().split() for t in texts]
    assert np.diff(first).tolist() == [len(w) for w in split]
    flat = [w for s in split for w in s]
    assert len(set(hashes.tolist())) == len(set(flat)) and hashes[0] == hashes[-1]


def test_equal_windows_share_anchors():
    text = np.frombuffer(b"the quick brown fox jumps over the lazy dog " * 3, np.uint8)
    values = random_table(1)[text]
    starts, at, hashes, _ = repeats.anchors(values, np.array([0, len(text)]), 20, 7)
    seen = {}
    for s, a in zip(starts.tolist(), at.tolist()):
        w = bytes(text[s : s + 20])
        assert seen.setdefault(w, a - s) == a - s and 0 <= a - s <= 13
    assert window_hash(running(values), np.array([0]), np.array([44])) == window_hash(running(values), np.array([44]), np.array([88]))


@pytest.mark.parametrize("name", ["op2_substring_dedup", "op5_suffix_dedup", "op7_jaccard_join"])
def test_queries_equal_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf)
    cur = con.execute(queries.SQL[name])
    cols = [c[0] for c in cur.description]
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, cur.fetchall())
