"""The ring against a simulation that walks it row by row."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import pytest

from corpusloom.llm import sharding
from tests.llm.conftest import corpus


def place(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def walk(rows, shards, vnodes):
    """Shard loads when rows that find their shard full go on clockwise, first come first served."""
    ring = sorted((place(f"node:{s}:{v}"), s, v) for s in range(shards) for v in range(vnodes))
    n = len(rows)
    room = [n // shards + (s < n % shards) for s in range(shards)]
    homes = Counter()
    for _, t in rows:
        p = place(t or "")
        homes[next((k for k, (x, _, _) in enumerate(ring) if x >= p), 0)] += 1
    got, waiting = Counter(), []
    for turn in range(2):
        for k, (_, s, _) in enumerate(ring):
            own = homes[k] if turn == 0 else 0
            stay = min(own, room[s])
            room[s] -= stay
            got[k, s] += stay
            waiting += [k] * (own - stay)
            while waiting and room[s]:
                got[waiting.pop(0), s] += 1
                room[s] -= 1
    assert not waiting
    return {x: c for x, c in got.items() if c}, ring


@pytest.mark.parametrize("shards,vnodes,seed", [(16, 8, 1), (3, 1, 2), (5, 16, 3), (1, 1, 4)])
def test_equals_the_walk(frame, shards, vnodes, seed):
    rows = corpus(seed, 120) + [(5000 + k, "copy of one text") for k in range(70)] + [(None, "x"), (None, None)]
    out = sharding.assign(frame(rows), shards, vnodes, target=7).collect()
    want, ring = walk(rows, shards, vnodes)
    text = {}
    for i, t in rows:
        text.setdefault((i, zlib.crc32((t or "").encode())), t or "")
    got = Counter()
    for r in out:
        p = place(text[r.doc_id, r.text_crc32])
        got[next((k for k, (x, _, _) in enumerate(ring) if x >= p), 0), r.shard] += 1
    assert dict(got) == want
    sizes = Counter(r.shard for r in out)
    loads = [sizes[s] for s in range(shards)]
    assert sum(loads) == len(rows) and max(loads) - min(loads) <= 1
    assert all(sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s])) for s in range(shards))
    for r in out:
        assert r.size == len(text[r.doc_id, r.text_crc32].encode()) + 1


def test_same_result_however_it_is_dealt(frame):
    rows = corpus(8, 60)
    a = sharding.assign(frame(rows), 4, 8, target=5)
    b = sharding.assign(frame(rows[::-1]).repartition(7), 4, 8, target=5)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_few_rows_move_when_one_is_added(frame):
    rows = [(k, f"text {k}") for k in range(400)]
    before = {r.doc_id: r.shard for r in sharding.assign(frame(rows)).collect()}
    after = {r.doc_id: r.shard for r in sharding.assign(frame([*rows, (999, "new")])).collect()}
    assert sum(after[k] != s for k, s in before.items()) <= 40


def test_empty_table_and_clashing_columns(frame, clashing):
    assert sharding.assign(frame([])).count() == 0
    rows = corpus(9, 30)
    assert sorted(map(str, sharding.assign(clashing(rows)).collect())) == sorted(map(str, sharding.assign(frame(rows)).collect()))


def test_no_python_on_the_path(frame):
    df = sharding.assign(frame(corpus(1, 10)))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
