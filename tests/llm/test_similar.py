"""The Jaccard join against all pairs."""

from __future__ import annotations

import random

import pytest

from corpusloom.llm import similar
from tests.llm.conftest import words


def brute(rows, n=5, threshold=0.8):
    texts = {t or "" for _, t in rows}
    sets = {}
    for t in texts:
        w = t.encode().split()
        sets[t] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    link = {t: [u for u in texts if u != t and sets[t] and len(sets[t] & sets[u]) / len(sets[t] | sets[u]) >= threshold] for t in texts}
    out = []
    for i, t in rows:
        reach, todo = set(), [t or ""]
        while todo:
            x = todo.pop()
            if x not in reach:
                reach.add(x)
                todo += link[x]
        ids = [j for j, u in rows if (u or "") in reach and j is not None]
        out.append((i, min(ids, default=None), len(link[t or ""]), sum((u or "") == (t or "") for _, u in rows)))
    return sorted(out, key=str)


def near_copies(seed, n=60):
    rng = random.Random(seed)
    rows, k = [], 0
    while len(rows) < n:
        base = words(rng, rng.randint(1, 60), 400).split()
        for _ in range(rng.choice([1, 1, 2, 6])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(len(w))] = f"x{rng.randrange(1000)}"
            rows.append((k * 2, " ".join(w)))
            k += 1
    rows += [(901, None), (900, ""), (902, "  "), (903, "one two"), (905, "one  two"), rows[0], rows[0], (None, rows[0][1]), (None, "only here")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_all_pairs(frame, seed):
    rows = near_copies(seed)
    out = similar.similar(frame(rows)).select("doc_id", "class_id", "n_links", "n_copies")
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows)


def test_blocks_of_one_large_group(frame):
    rng = random.Random(5)
    base = words(rng, 80, 400).split()
    rows = [(k, " ".join(base[:j] + [f"y{k}"] + base[j + 1 :])) for k in range(30) for j in [rng.randrange(80)]]
    out = similar.similar(frame(rows), block=8)
    assert sorted((tuple(r) for r in out.select("doc_id", "class_id", "n_links", "n_copies").collect()), key=str) == brute(rows)


def test_chain_is_one_class(frame):
    w = [f"t{k}" for k in range(60)]
    rows = [(k, " ".join(w[k * 3 : 40 + k * 3])) for k in range(4)]
    out = {r.doc_id: r for r in similar.similar(frame(rows)).collect()}
    assert {r.class_id for r in out.values()} == {0} and out[0].n_links < 3


def test_empty_table_and_clashing_columns(frame, clashing):
    assert similar.similar(frame([])).count() == 0
    rows = near_copies(7, 20)
    out = similar.similar(clashing(rows)).select("doc_id", "class_id", "n_links", "n_copies")
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows)


def test_one_of_each(clashing):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (3, "something else that is long enough"), (4, None), (5, None)]
    out = similar.one_of_each(clashing(rows))
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 4] and out.columns == clashing(rows).columns


def test_prefix_length_reaches_the_target():
    d = similar.prefix_length(0.8)
    assert 1 - (1 - 0.8**d) ** similar.TREES >= similar.RECALL > 1 - (1 - 0.8 ** (d + 1)) ** similar.TREES
    assert similar.prefix_length(0.05) == 1


def test_least_similarity_is_that_of_all_sizes():
    for t in (0.5, 0.8, 0.9):
        for s in range(1, 30):
            pairs = ((i, q) for i in range(1, s + 1) for q in range(i, 3 * s + 3) if not i == s == q)
            want = min((i / (s + q - i) for i, q in pairs if i / (s + q - i) >= t - 1e-12), default=1.0)
            assert similar.least_similarity(s, t) == pytest.approx(want), (t, s)


def test_labels_are_shortened_by_what_a_text_can_be_linked_to():
    args = (similar.THRESHOLD, similar.TREES, similar.DEPTH, similar.RECALL)
    assert [similar.label_length(s, *args) for s in (1, 3, 4, 6, 7, 500)] == [8, 8, 4, 5, 6, 4]


def test_trie_nodes_of_short_texts(frame):
    """Texts of seven and eight shingles stop at different depths and are linked; three of four are too few."""
    rng = random.Random(11)
    rows = []
    for k in range(40):
        base = words(rng, 16, 10**6).split()
        for n in (7, 8, 11, 12):
            rows.append((len(rows), " ".join(base[:n])))
    out = similar.similar(frame(rows)).select("doc_id", "class_id", "n_links", "n_copies")
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == brute(rows) and sum(r[2] for r in got) == 80


def test_trie_keeps_nodes_where_a_text_stops(spark):
    label = lambda *v: b"".join(x.to_bytes(2, "big") for x in v)
    rows = [
        (b"a", 1, 2, [label(1, 1, 1, 1)]),
        (b"b", 2, 3, [label(1, 1, 1, 2)]),
        (b"c", 3, 4, [label(1, 1, 1, 2)]),
        (b"d", 4, 3, [label(1, 1, 2, 2)]),
        (b"e", 5, 2, [label(9, 9, 9, 9)]),
    ]
    chosen, members = similar.trie_nodes(spark.createDataFrame(rows, "node binary, doc_id long, need int, labels array<binary>"), 4, 2)
    held = {}
    for r in members.join(chosen, "key").collect():
        held.setdefault(r.key, set()).add(bytes(r.node))
    # b stops at three values, where a stands; c stops at its whole label, where b stands; nobody comes up to a's two.
    assert sorted(map(sorted, held.values())) == [[b"a", b"b"], [b"b", b"c"]]
