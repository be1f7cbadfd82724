from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from corpusloom.llm import spelling


def brute(rows, every=199, min_length=6, min_count=5, ratio=5):
    """The contract, word by word and pair by pair."""
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1 :]
            if len(run) >= min_length:
                count[run] += 1
    n = {w: c for w, c in count.items() if c >= min_count}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    form, out = {}, {}
    others = {w: [v for v in n if v != w and near(w, v)] for w in n}
    for w, vs in others.items():
        top = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = top if top is not None and n[top] >= ratio * n[w] else None
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(others[w]), n[form[w]] if form[w] else None)
    return out


def result(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def mutated(rng: random.Random, word: str, letters: str) -> str:
    i = rng.randrange(len(word))
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i:], word[:i] + rng.choice(letters) + word[i + 1 :]])


def corpus(seed: int, letters: str, sizes: range) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    pool = ["".join(rng.choice(letters) for _ in range(rng.choice(sizes))) for _ in range(25)]
    for _ in range(3):
        pool += [mutated(rng, w, letters) for w in pool]
    weight = [rng.choice([1, 1, 5, 30, 200]) for _ in pool]
    rows: list[tuple[int | None, str | None]] = [
        (k, rng.choice([" ", ", ", "\n1"]).join(rng.choices(pool, weight, k=rng.randint(0, 200)))) for k in range(60)
    ]
    rows = [(d, t.upper() if d % 7 == 0 else t) for d, t in rows]
    return rows + [(100, None), (101, ""), (None, rows[1][1]), rows[2], rows[2]]


@pytest.mark.parametrize("seed, letters, sizes", [(1, "abcdeé", range(5, 9)), (2, "xyÿÀ×", range(4, 12)), (3, "ab", range(5, 60)), (4, "abcdefgh", range(44, 54))])
def test_equals_brute_force(spark, frame, seed, letters, sizes):
    rows = corpus(seed, letters, sizes)
    want = brute(rows, every=19)
    assert want
    assert result(spelling.variants(frame(rows), every=19)) == want


@pytest.mark.parametrize("symbols", [1, 2, 8, 40])
def test_number_of_symbols_changes_nothing(spark, frame, symbols):
    words = frame(corpus(7, "abcdefé", range(6, 9))).selectExpr("explode(split(text, '[^a-zé]+')) word").where("word <> ''").groupBy("word").count()
    pairs = {(r["a"], r["b"]) for r in spelling.near_pairs(words.withColumnRenamed("count", "n"), symbols).collect()}
    plain = [(r["a"], r["b"]) for r in spelling.near_pairs(words.withColumnRenamed("count", "n"), 3, long=2).collect()]
    assert pairs and {frozenset(p) for p in pairs} == {frozenset(p) for p in plain} and len(plain) == len(pairs)


def test_chain_of_forms_reaches_the_last(spark):
    forms = [(chr(97 + k), chr(98 + k), 5 ** (k + 2)) for k in range(9)] + [("x", None, None)]
    df = spark.createDataFrame(forms, "word string, form string, form_n long")
    assert {(r["word"], r["root"]) for r in spelling.roots(df).collect()} == {(chr(97 + k), "j") for k in range(9)}


def test_ties_take_the_smallest_word(spark, frame):
    text = " ".join(["walkin"] * 5 + ["walking"] * 30 + ["walkina"] * 30)
    assert result(spelling.variants(frame([(5, text)]), every=10**9))["walkin"] == ("walkina", "walkina", 5, 2, 30)


def test_long_words_and_empty_tables(spark, frame):
    long = "ab" * 20_000
    rows = [(k, f"{long} {long[:-1]} {'x' * 300}") for k in range(5)] + [(9, (long + " ") * 25)]
    assert result(spelling.variants(frame(rows), every=10**9)) == brute(rows, every=10**9)
    assert spelling.variants(frame([])).count() == 0
    assert spelling.variants(frame([(1, None), (2, "a b c")])).count() == 0


def test_extra_columns_do_not_disturb(spark, clashing, frame):
    rows = [(k, "vestring vestring vestrinp other words") for k in range(40)]
    assert result(spelling.variants(clashing(rows))) == result(spelling.variants(frame(rows)))


def test_plan_has_no_nested_loop(spark, frame):
    words = spark.createDataFrame([("abcdef", 5)], "word string, n long")
    plan = spelling.near_pairs(words)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_nothing_as_large_as_the_vocabulary_is_broadcast(spark, tmp_path):
    words = spark.createDataFrame([("abcdef", 50), ("abcdeg", 5), ("x" * 60, 50), ("x" * 61, 5)], "word string, n long")
    words.write.parquet(str(tmp_path / "words"))
    words = spark.read.parquet(str(tmp_path / "words"))  # a file has a size, and this one is below any threshold
    forms = spark.createDataFrame([("abcdeg", "abcdef", 50)], "word string, form string, form_n long")
    docs = spark.createDataFrame([(k, "vestring vestring vestrinp") for k in range(5)], "doc_id long, text string")
    for df in (spelling.near_pairs(words), spelling.roots(forms), spelling.variants(docs)):
        assert "BroadcastExchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert {frozenset((r["a"], r["b"])) for r in spelling.near_pairs(words).collect()} == {frozenset(("abcdef", "abcdeg")), frozenset(("x" * 60, "x" * 61))}
