from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string"


@pytest.fixture
def frame(spark):
    """A DataFrame of documents from (doc_id, text) pairs."""
    return lambda rows: spark.createDataFrame(list(rows), DOCS)


@pytest.fixture
def clashing(spark):
    """Documents with extra columns whose names the operators use inside."""

    def make(rows):
        extra = "part int, key string, node string, bucket int, n int, block int, score double, fold int, toxic int, pool int, arc int, cell int"
        return spark.createDataFrame([(*r, 7, "k", "n", 3, 4, 5, 0.5, 1, 1, 2, 9, 9) for r in rows], f"{DOCS}, {extra}")

    return make


def words(rng: random.Random, n: int, vocabulary: int = 12) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed: int, n: int = 40) -> list[tuple[int, str | None]]:
    """Random documents with copies, shared passages, empty and null texts and repeated rows."""
    rng = random.Random(seed)
    passage = [words(rng, rng.randint(20, 60), 500) for _ in range(4)]
    rows: list[tuple[int, str | None]] = []
    for k in range(n):
        body = [words(rng, rng.randint(0, 80), 300)]
        if rng.random() < 0.5:
            body.insert(rng.randrange(2), rng.choice(passage))
        if rng.random() < 0.2 and rows:
            body = [rng.choice(rows)[1] or ""]
        rows.append((k * 3, rng.choice([" ", "\n", " \t"]).join(body)))
    rows += [(1000, None), (1001, ""), (1002, " \n "), (1003, "ä" * 200), (1004, "a " * 400), rows[3], rows[3]]
    rng.shuffle(rows)
    return rows
