from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from corpusloom.llm import alignment
from corpusloom.llm.queries import tokenizer_path
from tests.llm.conftest import corpus

A, B = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")


def plain_groups(a, b):
    common = sorted(set(a) & set(b))
    return [a.index(x) + 1 for x in common], [b.index(x) + 1 for x in common]


@given(st.lists(st.tuples(st.booleans(), st.booleans()), max_size=200))
def test_groups_are_the_common_ends(cuts):
    # One entry per byte: whether a token of the first, of the second tokenizer ends there; both end at last.
    cuts = [*cuts, (True, True)]
    a = [k + 1 for k, (x, _) in enumerate(cuts) if x]
    b = [k + 1 for k, (_, y) in enumerate(cuts) if y]
    assert tuple(x.tolist() for x in alignment.groups(a, b)) == plain_groups(a, b)


@pytest.mark.parametrize("before", range(0, 40))
def test_stretches_of_every_length(before):
    a = [*range(1, before + 1), before + 3, *range(before + 4, before + 60)]
    b = [*range(1, before + 1), before + 1, before + 3, *range(before + 4, before + 60)]
    assert tuple(x.tolist() for x in alignment.groups(a, b)) == plain_groups(a, b)


def brute(rows):
    """The contract by comparing every two tokens of a text."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    from corpusloom.llm.packing import Encoder

    first, second = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    of = {k: t for t, k in Encoder(A).ranks.items()}
    links, out = [], []
    for doc, text in rows:
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids
        b = second.encode(text or "")
        bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(k) else p.replace("▁", " ").encode() for k, p in ((k, second.id_to_piece(k)) for k in b)]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(of[k] for k in a) != whole or b"".join(bytes_b) != whole:
            a, b, bytes_b = [], [], []
        ea, eb = np.cumsum([len(of[k]) for k in a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        mine = [
            (a[i], b[j])
            for i in range(len(a))
            for j in range(len(b))
            if max(ea[i - 1] if i else 0, eb[j - 1] if j else 0) < min(ea[i], eb[j])
        ]
        ga, gb = plain_groups(ea, eb)
        cut = zip([0, *ga], ga, [0, *gb], gb)
        text = ";".join(",".join(map(str, a[p:q])) + "|" + ",".join(map(str, b[r:s])) for p, q, r, s in cut)
        out.append((doc, len(a), len(b), len(ga), hashlib.sha256(text.encode()).hexdigest() if a else ""))
        links.append(mine)
    count = Counter(x for mine in links for x in mine)
    most: Counter = Counter()
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    return sorted(
        [(d, na, nb, ng, len(m), sum(count[x] == most[x[1]] for x in m), sum(count[x] for x in m), sha) for (d, na, nb, ng, sha), m in zip(out, links)],
        key=str,
    )


ODD = [
    (1, "<|endoftext|> and <s> </s> <unk> <0x41> stay text"),
    (2, "  two spaces\n\n\ttabs  and  more   "),
    (3, "café ☃ 漢字 \U0001f600 naïve"),
    (4, "a▁b"),
    (5, None),
    (6, ""),
    (7, " "),
    (8, "x" * 300 + " 12345678901234567890"),
    (9, "nul\x00byte \r\n é́"),
    (None, "no id"),
    (None, None),
]


@pytest.mark.parametrize("limit", [200, 1_000_000])
def test_equals_brute_force(spark, frame, limit):
    rows = ODD + corpus(5)
    got = alignment.align(frame(rows).repartition(3), A, B, limit)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
    assert got.columns == [c.split()[0] for c in alignment.RESULT.split(", ")]


def test_buckets_change_nothing(spark, frame, monkeypatch):
    rows = corpus(6)
    monkeypatch.setattr(alignment, "BUCKET_PAIRS", 7)
    assert sorted((tuple(r) for r in alignment.align(frame(rows), A, B, 500).collect()), key=str) == brute(rows)


def test_bytes_that_differ_have_no_tokens(spark, frame):
    (row,) = alignment.align(frame([(4, "a▁b")]), A, B).collect()
    assert tuple(row) == (4, 0, 0, 0, 0, 0, 0, "")


def test_very_long_text_empty_table_and_extra_columns(spark, frame, clashing):
    rng = random.Random(3)
    rows = [(1, " ".join(f"word{rng.randrange(99)}" for _ in range(60_000))), (2, "short")]
    one, two = sorted((tuple(r) for r in alignment.align(clashing(rows), A, B).collect()))
    assert one[1] > 100_000 and one[4] == one[1] + one[2] - one[3] and two[0] == 2
    assert alignment.align(frame([]), A, B).count() == 0
