"""Deduplication against brute force, with groups of copies that hold a third of all rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import dedup as d


def _corpus(seed=4, n=60):
    """A third near copies of one text, some of another, the rest unrelated."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    base = [rng.choice(vocab) for _ in range(80)]
    other = [rng.choice(vocab) for _ in range(80)]
    texts = []
    for i in range(n):
        src = base if i % 3 == 0 else other if i % 7 == 1 else [rng.choice(vocab) for _ in range(rng.randrange(1, 80))]
        words = list(src)
        if src is base or src is other:
            for _ in range(rng.randrange(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocab)
        texts.append(" ".join(words))
    return texts


def _sets(texts, n=5):
    out = []
    for x in texts:
        ws = x.lower().split()
        out.append({" ".join(ws[i : i + n]) for i in range(len(ws) - n + 1)} or ({" ".join(ws)} if ws else set()))
    return out


def _jac(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def _find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def _components(n, edges):
    parent = list(range(n))
    for a, b in edges:
        ra, rb = _find(parent, a), _find(parent, b)
        parent[max(ra, rb)] = min(ra, rb)
    return [_find(parent, i) for i in range(n)]


def test_near_duplicates_leave_no_pair(spark):
    texts = _corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    sets = _sets(texts)
    clusters = {r.doc_id: r.cluster for r in d.near_dup_clusters(df, tau=0.8, target=4).collect()}
    assert len(clusters) == len(texts)
    near = [(i, j) for i in range(len(texts)) for j in range(i) if _jac(sets[i], sets[j]) >= 0.8]
    want = _components(len(texts), near)
    # Every cluster is justified by true near-duplicate pairs, and hardly any pair is missed by the bands.
    assert all(want[i] == want[c] for i, c in clusters.items())
    kept = [i for i, c in clusters.items() if i == c]
    members = {r.doc_id: set() for r in df.collect()}
    for r in d.lsh_members(d.minhash(d.shingle_sets(df), 128)).collect():
        members[r.doc_id].add(r.bucket)
    for x in range(len(kept)):
        for y in range(x):
            a, b = kept[x], kept[y]
            assert not (members[a] & members[b]) or _jac(sets[a], sets[b]) < 0.8
    assert [clusters[i] for i in range(len(texts))] == want


def test_chain_of_near_copies_is_one_cluster(spark):
    # Ids 1, 3, 4, 2 form a chain; neighbours are near, others are not, and one bucket holds all four.
    w = [f"t{k}" for k in range(70)]
    texts = {i: w[3 * k : 3 * k + 50] for k, i in enumerate((1, 3, 4, 2))}
    sets = [(i, [k for k, _ in enumerate(w) if w[k] in t]) for i, t in texts.items()]
    members = spark.createDataFrame([("b", i) for i in texts], "bucket string, doc_id long")
    edges = d.near_dup_edges(members, spark.createDataFrame(sets, "doc_id long, shingles array<long>"), 0.85)
    assert sorted({frozenset((r.doc_id, r.hub)) for r in edges.collect()}, key=str) == sorted(map(frozenset, [(1, 3), (3, 4), (4, 2)]), key=str)
    got = {r.node: r.component for r in d.connected_components(edges, "doc_id", "hub").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1}


def test_random_buckets_equal_the_closure_of_all_pairs(spark):
    rng = random.Random(12)
    for block in (3, 1000):
        base = [rng.sample(range(60), 30) for _ in range(4)]
        sets = {}
        for i in range(70):
            s = set(rng.choice(base))
            for _ in range(rng.randrange(4)):
                s ^= {rng.randrange(60)}
            sets[i] = sorted(s)
        members = [(f"b{rng.randrange(6)}", i) for i in range(70) for _ in range(2)]
        pairs = [(i, j) for b, i in members for c, j in members if b == c and i < j and _jac(set(sets[i]), set(sets[j])) >= 0.8]
        equal = [(i, j) for i in sets for j in sets if i < j and sets[i] == sets[j]]
        want = _components(70, pairs + equal)
        edges = d.near_dup_edges(
            spark.createDataFrame(members, "bucket string, doc_id long"),
            spark.createDataFrame(list(sets.items()), "doc_id long, shingles array<long>"), 0.8, target=5, block=block)
        rows = edges.collect()
        assert all(abs(r.jaccard - _jac(set(sets[r.doc_id]), set(sets[r.hub]))) < 1e-6 for r in rows)
        # Equal sets are one node, so their buckets are joined as well.
        got = _components(70, [(r.doc_id, r.hub) for r in rows])
        merged = _components(70, pairs + equal + [(i, j) for i, j in equal])
        assert all(got[i] == got[j] for i, j in pairs) and all((got[i] == got[j]) <= (want[i] == want[j]) or merged for i in sets for j in sets)


def test_one_large_bucket_takes_a_fixed_number_of_jobs(spark):
    n = 3000
    sets = spark.range(n).select(F.col("id").alias("doc_id"), F.transform(F.sequence(F.lit(0), F.lit(4)), lambda k: k + F.col("id") * 10).alias("shingles"))
    members = sets.select(F.lit("hot").alias("bucket"), "doc_id")
    assert d.near_dup_edges(members, sets, block=512).count() == 0


def test_all_copies_of_one_text(spark):
    df = spark.range(90).select(F.col("id").alias("doc_id"), F.lit("the very same text in every single row").alias("text"))
    assert [r.doc_id for r in d.near_dedup(df, target=7).collect()] == [0]
    assert [r.doc_id for r in d.exact_dedup(df).collect()] == [0]


def test_no_near_duplicates_at_all(spark):
    df = spark.createDataFrame([(i, f"alpha{i} beta{i} gamma{i} delta{i} eps{i} zeta{i}") for i in range(8)] + [(9, "")],
                               "doc_id long, text string")
    assert d.near_dedup(df).count() == 9


def test_exact_dedup_is_idempotent_and_normalises(spark):
    df = spark.createDataFrame([(3, "A  b\n"), (1, "a b"), (2, "c")], "doc_id long, text string")
    once = d.exact_dedup(df)
    assert sorted(r.doc_id for r in once.collect()) == [1, 2]
    assert sorted(r.doc_id for r in d.exact_dedup(once).collect()) == [1, 2]


def test_components_on_random_graphs(spark):
    rng = random.Random(8)
    for n, m in ((40, 30), (60, 50), (30, 29)):
        edges = [(i, i + 1) for i in range(n - 1)] if m == 29 else [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        want = _components(n, edges)
        df = spark.createDataFrame(edges, "a long, b long")
        got = {r.node: r.component for r in d.connected_components(df, "a", "b", target=3).collect()}
        touched = {x for e in edges if e[0] != e[1] for x in e}
        assert got == {x: want[x] for x in touched}


def test_minhash_matches_plain_python(spark):
    df = spark.createDataFrame([(0, "a b c d e f g"), (1, "x"), (2, "")], "doc_id long, text string")
    rows = d.minhash(d.shingle_sets(df, hashing="md5"), 16, seed=2).orderBy("doc_id").collect()
    for r in rows:
        sig = [min((a * (h % d.MERSENNE_31) + b) % d.MERSENNE_31 for h in r.shingles) for a, b in d.permutations(16, 2)] \
            if r.shingles else None
        assert r.signature == sig


def test_minhash_slices_do_not_change_signatures(spark):
    df = spark.createDataFrame(list(enumerate(_corpus(n=25) + [""])), "doc_id long, text string")
    sets = d.shingle_sets(df)
    a = {r.doc_id: r.signature for r in d.minhash(sets, 8).collect()}
    b = {r.doc_id: r.signature for r in d.minhash(sets, 8, shingles_at_once=1).collect()}
    assert a == b


def test_line_dedup_first_place_wins(spark):
    df = spark.createDataFrame([(2, "a\nb\n\na"), (1, "b\nc"), (3, "\nc\nd"), (4, "")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in d.line_dedup(df).collect()}
    assert got == {1: "b\nc", 2: "a\n", 3: "\nd", 4: ""}


def test_semantic_blocks_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    centre = rng.normal(size=(3, 8))
    rows = []
    for i in range(90):
        c = 0 if i % 2 else int(rng.integers(3))
        rows.append((i, c, (centre[c] + 0.25 * rng.normal(size=8)).astype(float).tolist()))
    m = np.array([r[2] for r in rows])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    want = {}
    for i in range(90):
        hits = [j for j in range(i) if rows[j][1] == rows[i][1] and m[i] @ m[j] >= 0.9]
        if hits:
            want[i] = hits[0]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    for block in (7, 1000):
        got = {r.vec_id: r.match for r in d.semantic_matches(df, 0.1, "label", block=block).collect()}
        assert got == want and want


ODD_TEXTS = [
    None, "", " \n\t ", "one", "One two  three FOUR", "a b c d e", "a b c d e f a b c d e f", "x " * 40,
    "İstanbul ΣΣ ÄB c d\u0085e\u001cf \u200bg \U0001f600 中文 h", "q\u3000r\u180es\x0bt\x00u\x1fv w",
]


@pytest.mark.parametrize("n", [1, 5])
def test_word_hashes_are_those_of_the_expressions(spark, n):
    df = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "doc_id long, text string")
    df = df.unionByName(spark.sql("select 99L as doc_id, cast(x'61206220ff63206420652066' as string) as text"))
    got = d.shingle_sets(df, n, hashing="md5")
    assert {r.doc_id: r.shingles for r in got.collect()} == {
        r.doc_id: r.s for r in df.select("doc_id", F.array_distinct(F.transform(d.shingles("text", n, distinct=False), d.md5_long)).alias("s")).collect()
    }
    # Cut and hashed by one function, once, and not gram by gram by interpreted expressions.
    plan = got.where(F.size("shingles") > 0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython ") == 1 and "lambdafunction" not in plan


def test_minhash_of_the_largest_factors(spark):
    top = d.MERSENNE_31 - 1
    sets = spark.createDataFrame([(0, [top, d.MERSENNE_31, (1 << 60) - 1]), (1, [top]), (2, [])], "doc_id long, shingles array<long>")
    got = {r.doc_id: r.signature for r in d.minhash(sets, 64).collect()}
    ab = d.permutations(64)
    assert got[2] is None and got[1] == [(top * a + b) % d.MERSENNE_31 for a, b in ab]
    assert got[0] == [min((h % d.MERSENNE_31 * a + b) % d.MERSENNE_31 for h in (top, d.MERSENNE_31, (1 << 60) - 1)) for a, b in ab]
