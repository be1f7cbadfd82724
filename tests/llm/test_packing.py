"""Exact round trips of pieces, and sequences that keep within their capacity."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from corpusloom.llm import packing
from corpusloom.llm.queries import tokenizer_path
from tests.llm.conftest import corpus

FILE = tokenizer_path()


def whole_ids(text):
    return Tokenizer.from_file(FILE).encode(text or "", add_special_tokens=False).ids + [0]


def check(rows, out, capacity):
    want = []
    for i, t in rows:
        ids = whole_ids(t)
        at = 0
        for k, (s, n) in enumerate(packing.cut(len(ids), capacity)):
            assert s == at and 1 <= n <= capacity and (n == capacity or k == 0)
            want.append((i, k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())))
            at += n
        assert at == len(ids)
    assert sorted((tuple(r)[:5] for r in out), key=str) == sorted(want, key=str)
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= capacity
    return len(bins), -(-sum(w[3] for w in want) // capacity)


@pytest.mark.parametrize("capacity,pool", [(64, 20_000), (16, 10), (2048, 5)])
def test_round_trip(frame, capacity, pool):
    rows = corpus(3, 30) + [(None, "no id"), (7001, "long " * 3000), (7002, "it's odd\r\n\ttext  <|endoftext|> 　 x"), (7003, "日本語 🎉")]
    out = packing.best_fit_pack(frame(rows), FILE, capacity, pool).collect()
    n, least = check(rows, out, capacity)
    assert n <= least + max(2, least // 10, 2 * len(rows) // pool)


def test_few_sequences_are_left_open():
    rng = np.random.default_rng(1)
    lengths = np.sort(np.minimum(rng.lognormal(6, 1, 20_000).astype(int) + 1, 2047))[::-1]
    where, at = packing.sum_of_squares(lengths)
    least = -(-lengths.sum() // 2048)
    assert where.max() + 1 <= 1.003 * least


def test_sum_of_squares_takes_the_smallest_sum():
    """Every step against the rule spelled out."""
    rng = random.Random(2)
    lengths = np.array([rng.randint(1, 20) for _ in range(300)])
    where, at = packing.sum_of_squares(lengths, 20)
    gap: dict[int, int] = {}

    def total(g):
        count = defaultdict(int)
        for x in g.values():
            if x:
                count[x] += 1
        return sum(c * c for c in count.values())

    for s, b, o in zip(lengths.tolist(), where.tolist(), at.tolist()):
        choices = {x: total(gap | {x: gap[x] - s}) for x in gap if gap[x] >= s}
        assert o == 20 - gap.get(b, 20)
        if choices:
            assert choices[b] == min(choices.values())
        gap[b] = gap.get(b, 20) - s


def test_ids_equal_the_tokenizer():
    enc, ref = packing.encoder(FILE), Tokenizer.from_file(FILE)
    rng = random.Random(4)
    alphabet = "ab cd'sll re\n\n\t\r   \u0085\x1céßñ日本🎉12.,!-_<|>endoftext"
    for _ in range(400):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        assert list(enc.ids(t)) == ref.encode(t, add_special_tokens=False).ids


def test_empty_table_and_clashing_columns(frame, clashing):
    assert packing.best_fit_pack(frame([]), FILE).count() == 0
    rows = corpus(5, 10)
    check(rows, packing.best_fit_pack(clashing(rows), FILE, 32).collect(), 32)
