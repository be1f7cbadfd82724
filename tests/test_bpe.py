"""Byte-pair training against a trainer that merges one pair at a time, and exact round trips."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from corpusloom.operators import bpe

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


def merged(word, a, b, new):
    out, i = [], 0
    while i < len(word):
        if i + 1 < len(word) and word[i] == a and word[i + 1] == b:
            out.append(new)
            i += 2
        else:
            out.append(word[i])
            i += 1
    return out


def plain_train(texts, n_merges, min_count=2):
    count = Counter(p for t in texts for p in re.findall(bpe.PIECE, t or ""))
    words = [([1 + x for x in p.encode()], n) for p, n in count.items()]
    out = []
    for k in range(n_merges):
        pairs = Counter()
        for w, n in words:
            for x in zip(w, w[1:]):
                pairs[x] += n
        (a, b), n = min(pairs.items(), key=lambda x: (-x[1], max(x[0]), x[0]), default=((0, 0), 0))
        if n < min_count:
            break
        out.append((k, a, b, 257 + k, n))
        words = [(merged(w, a, b, 257 + k), m) for w, m in words]
    return out


def plain_ids(text, merges):
    out = []
    for p in re.findall(bpe.PIECE, text):
        ids = [1 + x for x in p.encode()]
        for _, a, b, c, _ in merges:
            ids = merged(ids, a, b, c)
        out += ids
    return out


def corpus(seed):
    rng = random.Random(seed)
    letters = ["ab", "abc", "aé", "abcdefgh", "a"][seed % 5]
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 30))) for _ in range(40)]
    return texts + ["", " ", "\n\n a  b\t", "漢字 ☃ \U0001f600", None, texts[0], "a" * 500]


@pytest.mark.parametrize("seed", range(5))
def test_merges_equal_a_plain_trainer(spark, seed):
    texts = corpus(seed)
    df = spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(3)
    merges = bpe.train(df, 60, write_every=2)
    want = plain_train(texts, 60)
    assert [tuple(r) for r in merges.orderBy("rank").collect()] == want
    rows = bpe.tokenize(df, merges).collect()
    for r in rows:
        t = texts[r["doc_id"]]
        assert r["tokens"] == (None if t is None else plain_ids(t, want) + [0] if t else [])
        assert r["n_tokens"] == (None if t is None else len(r["tokens"]))
    back = {r["doc_id"]: r["text"] for r in bpe.detokenize(bpe.tokenize(df, merges), merges).collect()}
    assert back == dict(enumerate(texts))


def test_several_merges_go_together():
    pairs = [(1, 2, 9), (3, 4, 8), (1, 5, 7), (2, 6, 6), (7, 8, 5)]
    assert bpe.independent(pairs) == pairs[:3]  # (2, 6) begins with the right symbol of (1, 2)
    assert bpe.independent([(4, 4, 9), (1, 2, 8)]) == [(4, 4, 9)]
    assert bpe.independent([]) == []


def test_runs_merge_from_the_left():
    symbols, owner = np.array([5, 5, 5, 5, 5, 7, 5, 5, 5]), np.array([0, 0, 0, 0, 0, 0, 0, 1, 1])
    out, own = bpe.merge_pairs(symbols, owner, [(5, 5, 9)])
    assert out.tolist() == [9, 9, 5, 7, 5, 9] and own.tolist() == [0, 0, 0, 0, 0, 1]


def test_long_pieces_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "xyz" * 100_000), (2, "xyz xyz")], DOCS)
    merges = bpe.train(df, 12)
    got = bpe.detokenize(bpe.tokenize(df, merges, append_eod=False), merges).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {1: "xyz" * 100_000, 2: "xyz xyz"}
    empty = spark.createDataFrame([], DOCS)
    assert bpe.train(empty, 10).count() == 0 and bpe.tokenize(empty, merges).count() == 0
    none = bpe.tokenize(df, bpe.train(empty, 10), append_eod=False)
    assert {r["n_tokens"] for r in none.collect()} == {300_000, 7}


def test_whole_table_comes_back(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    merges = bpe.train(docs, 100)
    back = bpe.detokenize(bpe.tokenize(docs, merges), merges)
    wrong = back.withColumnRenamed("text", "back").join(docs, "doc_id").where("not (back <=> text)")
    assert merges.count() == 100 and wrong.count() == 0 and back.count() == docs.count()
