"""Cosine neighbours by pivots against all pairs."""

from __future__ import annotations

from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pytest

from corpusloom.operators import neighbours
from corpusloom.session import durable_dir

VECTORS = "vec_id long, embedding array<double>"


def vectors(seed, n=150, dim=6):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(12, dim))
    rows = [(k, (centre[rng.integers(12)] * rng.uniform(0.5, 3) + rng.normal(scale=rng.choice([0.05, 0.3, 1.0]), size=dim)).tolist()) for k in range(n)]
    return rows + [(n, rows[3][1]), (n + 1, rows[3][1]), (n + 2, [0.0] * dim), (n + 3, None), (n + 4, []), (n + 5, [float("nan")] * dim), (n + 6, (-np.array(rows[5][1])).tolist())]


def brute(rows, eps):
    good = [(k, np.array(v) / np.linalg.norm(v)) for k, v in rows if v and np.isfinite(v).all() and any(v)]
    out = {}
    for k, u in good:
        near = [j for j, v in good if j < k and u @ v >= 1 - eps]
        if near:
            out[k] = min(near)
    return out


@pytest.mark.parametrize("seed, eps, pivots, block", [(1, 0.1, 8, 1024), (2, 0.3, 3, 7), (3, 0.02, 40, 5), (4, 0.8, 16, 20), (5, 0.1, 1, 16), (6, 1e-9, 8, 1024)])
def test_matches_equal_all_pairs(spark, seed, eps, pivots, block):
    rows = vectors(seed)
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    got = neighbours.matches(df, eps, pivots=pivots, block=block).collect()
    assert {r["vec_id"]: r["match"] for r in got} == brute(rows, eps) and len(got) == len(brute(rows, eps))


def test_pivots_prune():
    rng = np.random.default_rng(1)
    u = rng.normal(size=(2000, 3))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    row, _, own, _ = neighbours.places(u, u[:64], 0.02)
    assert own.sum() == 2000 and len(row) < 2 * len(u)


def test_copies_and_empty_tables(spark):
    df = spark.range(3000).selectExpr("id as vec_id", "array(1.0D, 2.0D, cast(id % 2 as double)) as embedding")
    got = neighbours.matches(df, 0.001, target=100)
    assert got.count() == 2998 and {r["match"] for r in got.collect()} == {0, 1}
    assert neighbours.dedup(df, 0.001).count() == 2
    assert neighbours.matches(df.where("false"), 0.1).count() == 0


def test_plan_has_no_nested_loop(spark):
    plan = neighbours.matches(spark.createDataFrame(vectors(1), VECTORS), 0.1)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("dim, eps, cells", [(3, 0.0002, True), (64, 0.65, False)])
def test_cells_only_where_they_rule_something_out(spark, dim, eps, cells):
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=dim).tolist()) for k in range(400)]

    def written():
        return set(Path(urlparse(durable_dir(spark)).path).glob("placed-*"))

    known = written()
    got = neighbours.matches(spark.createDataFrame(rows, VECTORS), eps, block=20).collect()
    assert {r["vec_id"]: r["match"] for r in got} == brute(rows, eps)
    assert bool(written() - known) == cells


def test_copies_that_travel():
    assert neighbours.copies({(0, 0): 30, (0, 1): 5, (1, 1): 7}, 10) == 30 * 4 + 5 * 4 + 7
    assert neighbours.copies({}, 10) == 0
