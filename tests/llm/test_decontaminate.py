"""String tiling against its rule, and leaks in all sorts of documents."""

from __future__ import annotations

import random
import time

import pytest

from corpusloom.llm import decontaminate
from tests.llm.conftest import corpus, words

ITEMS = "item_id long, text string"


def plain_tiles(item, text, least):
    """Mark the longest common unmarked run (first in item, then in text) until none is long enough."""
    used_i, used_t, tiles = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for t in range(len(text)):
                n = 0
                while i + n < len(item) and t + n < len(text) and item[i + n] == text[t + n] and i + n not in used_i and t + n not in used_t:
                    n += 1
                best = max(best, (n, -i, -t))
        n, i, t = best[0], -best[1], -best[2]
        if n < least:
            return tiles
        used_i |= set(range(i, i + n))
        used_t |= set(range(t, t + n))
        tiles.append((i, t, n))


@pytest.mark.parametrize("seed", range(12))
def test_tiles_equal_the_plain_rule(seed):
    rng = random.Random(seed)
    item = [rng.randrange(1 << 40) for _ in range(30)]
    parts = [item[a : a + rng.randint(3, 15)] for a in rng.sample(range(25), 4)]
    text = [x for p in parts for x in [*p, rng.randrange(1 << 40)]]
    mine, plain = decontaminate.tile(item, text, 4), plain_tiles(item, text, 4)
    assert sum(n for *_, n in mine) == sum(n for *_, n in plain)
    assert all(item[i : i + n] == text[t : t + n] for i, t, n in mine)
    for side in (0, 1):
        spots = [k for x in mine for k in range(x[side], x[side] + x[2])]
        assert len(spots) == len(set(spots))


def test_repeated_words_end():
    assert decontaminate.tile([7] * 60, [7] * 2000, 5) == [(0, 0, 60)]


@pytest.mark.parametrize("seed", range(40))
def test_tiles_of_words_that_repeat(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 4)
    item, text = ([rng.randrange(n) for _ in range(rng.randint(1, k))] for k in (40, 60))
    assert decontaminate.tile(item, text, 3) == plain_tiles(item, text, 3)


def test_long_runs_of_one_word_take_linear_time():
    begin = time.process_time()
    assert decontaminate.tile([7] * 800, [7] * 20_000, 5) == [(0, 0, 800)]
    assert time.process_time() - begin < 0.5
    assert sum(n for *_, n in decontaminate.tile([7] * 800 + [8], [7] * 300 + [9] + [7] * 200_000, 5)) == 800


def test_a_seed_of_many_items_is_pruned(spark, frame):
    """All items share one passage that covers none of them far enough."""
    rng = random.Random(8)
    shared = words(rng, 10, 5000)
    items = [(k, f"{words(rng, 60, 5000)} {shared}") for k in range(300)]
    docs = [(k, f"{shared} {words(rng, 30, 5000)}") for k in range(200)] + [(900, items[7][1])]
    found = decontaminate.contaminated(frame(docs), spark.createDataFrame(items, ITEMS)).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(900, 7)]


def leaks():
    rng = random.Random(3)
    items = [(k, words(rng, 40, 5000)) for k in range(6)] + [(90, None), (91, ""), (92, "too short"), (93, "ä" * 10)]
    docs = [(10 + k, words(rng, 200, 5000)) for k in range(30)]
    first = items[0][1].split()
    docs[0] = (10, docs[0][1] + " " + items[0][1])
    docs[1] = (11, " ".join(first[20:] + ["and", "so"] + first[:20]) + " " + docs[1][1])
    docs[2] = (12, items[1][1].upper().replace(" ", "!! "))
    docs[3] = (13, " ".join(first[:12]) + " " + docs[3][1])
    docs[4] = (14, items[2][1] + "\n" + items[3][1])
    docs += [(None, items[4][1]), (60, None), (61, ""), (62, items[5][1] + " x" * 50_000), docs[0]]
    return items, docs


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_finds_leaks_and_leaves_the_rest(spark, clashing, block_bytes):
    items, docs = leaks()
    table = spark.createDataFrame([(*i, 1) for i in items], ITEMS + ", doc_id int")
    out = decontaminate.contaminated(clashing(docs), table, block_bytes=block_bytes)
    got = sorted(((r.doc_id or -1), r.item_id) for r in out.collect())
    assert got == [(-1, 4), (10, 0), (10, 0), (11, 0), (12, 1), (14, 2), (14, 3), (62, 5)]
    kept = decontaminate.decontaminate(clashing(docs), table, block_bytes=block_bytes)
    assert kept.columns == clashing(docs).columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == sorted((i or -1) for i, _ in docs if i not in (10, 11, 12, 14, 62))


def test_coverage_of_reordered_halves(spark, frame):
    items, docs = leaks()
    r = decontaminate.contaminated(frame(docs[1:2]), spark.createDataFrame(items, ITEMS)).first()
    assert (r.coverage, r.n_tiles, r.matched_words, r.item_words) == (1.0, 2, 40, 40)


def test_empty_tables(spark, frame):
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.contaminated(frame(corpus(1, 5)), none).count() == 0
    assert decontaminate.contaminated(frame([]), spark.createDataFrame([(1, "a b c d e f g")], ITEMS)).count() == 0
    assert decontaminate.decontaminate(frame([(1, "x"), (None, None)]), none).count() == 2


def test_items_that_repeat(spark, frame):
    items = spark.createDataFrame([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g")], ITEMS)
    out = decontaminate.contaminated(frame([(5, "x a b c d e f g y")]), items)
    assert sorted(r.item_id for r in out.collect()) == [1, 1, 2]
    assert decontaminate.coverage_by_item(out).where("item_id = 1").first().n_docs == 1
