"""The parsing against a plain version, shared signatures of equal substrings, and the chain of next documents."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from corpusloom.llm import fingerprint
from tests.llm.conftest import corpus, words


def plain_toss(x, left):
    d = x ^ left
    place = (d & -d).bit_length() - 1
    return 2 * place + (x >> place & 1)


def plain_begins(symbols):
    """Where phrases begin in one document, symbol by symbol."""
    full = (1 << 64) - 1
    label = [plain_toss(x, symbols[k - 1] if k else full ^ x) for k, x in enumerate(symbols)]
    for _ in range(3):
        label = [plain_toss(x, label[k - 1] if k else x ^ 1) for k, x in enumerate(label)]
    assert all(x < 6 for x in label[1:])
    n = len(label)
    return [
        k == 0 or (k > 1 and label[k] > label[k - 1] and label[k] >= (label[k + 1] if k + 1 < n else -1)) for k in range(n)
    ]


@pytest.mark.parametrize("seed", range(5))
def test_phrases_begin_where_the_plain_version_says(seed):
    rng = random.Random(seed)
    docs = []
    for _ in range(30):
        d = [rng.randrange(1 << 64) if rng.random() < 0.5 else rng.randrange(3) for _ in range(rng.randint(0, 40))]
        docs.append([x for k, x in enumerate(d) if not k or x != d[k - 1]])
    symbols = np.array([x for d in docs for x in d], np.uint64)
    first = np.r_[0, np.cumsum([len(d) for d in docs])]
    assert fingerprint._ends(symbols, first).tolist() == [b for d in docs for b in plain_begins(d)]


def test_equal_substrings_share_interior_names():
    rng = random.Random(3)
    middle = words(rng, 400, 5000)
    texts = [words(rng, a, 5000) + " " + middle + " " + words(rng, 30, 5000) for a in (10, 37)]
    for level, (names, at) in enumerate(fingerprint.parse(*fingerprint._code_points(texts)), 1):
        if level > 3:
            break
        a, b = set(names[: at[1]].tolist()), set(names[at[1] :].tolist())
        inside = {n.tobytes() for n, _ in [(x[0], 0) for x in fingerprint.parse(*fingerprint._code_points([middle]))][level - 1 : level]}
        assert inside and len(a & b) > 0.6 * min(len(a), len(b))


def test_levels_end_and_phrases_grow():
    text = words(random.Random(1), 2000, 900)
    sizes = [len(n) for n, _ in fingerprint.parse(*fingerprint._code_points([text, "", "a", "b" * 5000]))]
    assert all(b < 0.7 * a for a, b in zip(sizes[:4], sizes[1:5])) and sizes[-1] == 3


def test_results_do_not_depend_on_neighbours():
    rng = random.Random(9)
    texts = [words(rng, rng.randint(0, 200), 300) for _ in range(25)] + ["", "x", "é" * 90]
    alone = [fingerprint.written(fingerprint.sketches([t])[0]) for t in texts]
    assert [fingerprint.written(s) for s in fingerprint.sketches(texts)] == alone


def chain(rows):
    """(row, its next) in falling doc_id, rows that share an id by the SHA-256 of their texts, none last."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.sha256((r[1] or "").encode()).digest()))
    return list(zip(order, order[1:] + order[:1]))


@pytest.mark.parametrize("block", [2, 1024])
def test_edited_texts_and_likeness(frame, block):
    rows = corpus(6, 40) + [(None, "last of all " * 9), (None, None), (2, "日本語 é 🎉" * 30)]
    out = fingerprint.compare_with_next(frame(rows), block).collect()
    want = []
    for (i, t), (_, after) in chain(rows):
        t, after = t or "", after or ""
        n = len(t) // 3
        e = t[: len(t) - n] + after[:n]
        a, b, c = (fingerprint.sketches([x])[0] for x in (t, e, after))
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), fingerprint.written(a), fingerprint.written(b), fingerprint.likeness(a, b), fingerprint.likeness(a, c)))
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))


def test_one_document_and_none(frame, clashing):
    (r,) = fingerprint.compare_with_next(frame([(5, "abc def " * 20)])).collect()
    assert r.near_next == 1.0 and fingerprint.compare_with_next(frame([])).count() == 0
    rows = corpus(2, 12)
    assert sorted(map(str, fingerprint.compare_with_next(clashing(rows), 3).collect())) == sorted(map(str, fingerprint.compare_with_next(frame(rows), 3).collect()))


def test_likeness_follows_the_true_share():
    rng = random.Random(4)
    base = words(rng, 1500, 3000).split()
    got = []
    for part in (0.0, 0.1, 0.3, 0.6, 1.0):
        other = words(rng, 1500, 3000).split()
        k = int(len(base) * part)
        a, b = (fingerprint.sketches([" ".join(x)])[0] for x in (base, base[: len(base) - k] + other[:k]))
        got.append(fingerprint.likeness(a, b))
    assert got[0] == 1.0 and got[-1] <= 0.05 and all(x >= y - 0.1 for x, y in zip(got, got[1:])) and 0.3 < got[2] < 0.75
