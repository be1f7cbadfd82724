"""Phrases in texts by an automaton, by a join, and by plain counting."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import terms as t

DOCS = "doc_id long, text string, term string, n int"


def brute(rows, phrases):
    bare = lambda s: [w for w in (x.strip(".,!?;-1234567890") for x in (s or "").lower().split()) if w]
    out = {}
    for p in {tuple(bare(p)) for p in phrases} - {()}:
        for i, s in rows:
            w = bare(s)
            n = sum(tuple(w[k : k + len(p)]) == p for k in range(len(w) - len(p) + 1))
            if n:
                out[i, " ".join(p)] = out.get((i, " ".join(p)), 0) + n
    return sorted(((i, p, n) for (i, p), n in out.items()), key=str)


@pytest.mark.parametrize("max_chars", [t.MAX_CHARS, 0])
def test_equals_plain_counting(spark, max_chars):
    rng = random.Random(3)
    word = lambda: rng.choice(["ab", "a", "b", "aba", "é"]) + rng.choice(["", "", ",", "!"])
    rows = [(k, " ".join(word() for _ in range(rng.randint(0, 60)))) for k in range(30)]
    rows += [(100, None), (101, ""), (102, "A  AB\n-- a"), (None, "a b"), rows[0], (103, "a " * 30_000)]
    phrases = ["a", "A b", "a, b", "ab a", "a b a", "b", "é é", "--", "", None, "abab", "a a a"]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS)
    table = spark.createDataFrame([(p,) for p in phrases], "term string")
    got = t.find_terms(docs, table, max_chars=max_chars)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, [p for p in phrases if p])


@pytest.mark.parametrize("max_chars", [t.MAX_CHARS, -1])
def test_empty_tables(spark, max_chars):
    docs = spark.createDataFrame([(1, "a", "x", 1)], DOCS)
    table = spark.createDataFrame([("a",)], "term string")
    assert t.find_terms(docs.limit(0), table, max_chars=max_chars).count() == 0
    if max_chars > 0:
        assert t.find_terms(docs, table.limit(0), max_chars=max_chars).count() == 0


def test_many_terms_in_one_pass(spark):
    table = spark.range(100_000).selectExpr("concat('w', translate(id, '0123456789', 'abcdefghij'), ' x') as term")
    docs = spark.createDataFrame([(1, "wba x wba x wjjjjj x wjjjjjj x", "", 0)], DOCS)
    assert sorted((r.term, r.n) for r in t.find_terms(docs, table).collect()) == [("wba x", 2), ("wjjjjj x", 1)]


@pytest.mark.parametrize("most", [t.MAX_SLOTS, 1 << 12])
def test_sequences_are_filtered_before_they_meet_the_table(spark, most):
    table = spark.range(500).selectExpr("concat('w', id, ' x') as term")
    maybe = t.maybe_listed(table, most=most)
    seen = spark.range(20_000).selectExpr("id", "concat('w', id, ' x') as term").withColumn("passes", maybe(F.xxhash64("term")))
    rows = seen.collect()
    assert all(r.passes for r in rows if r.id < 500)
    assert sum(r.passes for r in rows if r.id >= 500) < (1000 if most == t.MAX_SLOTS else 3000)
    assert spark.createDataFrame([("a",)], "term string").where(t.maybe_listed(table.limit(0))(F.xxhash64("term"))).count() == 0
