"""Permutations without a sort."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import permute as P


def plain(x, n, seed):
    a, b = P.digits(n)
    while True:
        left, right = divmod(x, b)
        for k, (m, c, d) in enumerate(P.keys(seed)):
            t = ((right if k % 2 == 0 else left) * m + c) % P.PRIME
            t = (t * t + d) % P.PRIME
            if k % 2 == 0:
                left = (left + t % a) % a
            else:
                right = (right + t % b) % b
        x = left * b + right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 31, 97, 101, 1000, 1009, 65_537])
def test_bijection_and_inverse(spark, n):
    x = F.col("id")
    rows = spark.range(n).select("id", P.permute(x, n, 3).alias("p"), P.unpermute(P.permute(x, n, 3), n, 3).alias("back")).collect()
    assert sorted(r["p"] for r in rows) == list(range(n)) and all(r["back"] == r["id"] for r in rows)
    assert all(r["p"] == plain(r["id"], n, 3) for r in rows[:300])


def test_large_domains_and_nulls(spark):
    n = 10**15 + 37
    values = [0, 1, n // 2, n - 1, n - 2, 12345678901]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x long")
    rows = df.select("x", P.permute(F.col("x"), n, 9).alias("p")).select("x", "p", P.unpermute(F.col("p"), n, 9).alias("back")).collect()
    assert all(r["back"] == r["x"] and (r["x"] is None) == (r["p"] is None) for r in rows)
    assert all(r["p"] == plain(r["x"], n, 9) for r in rows if r["x"] is not None)


def test_seeds_differ_and_order_is_gone(spark):
    rows = spark.range(5000).select(P.permute(F.col("id"), 5000, 1).alias("a"), P.permute(F.col("id"), 5000, 2).alias("b")).collect()
    assert sum(r["a"] == r["b"] for r in rows) < 20
    up = sum(x["a"] < y["a"] for x, y in zip(rows, rows[1:]))
    assert 2300 < up < 2700


def test_no_exchange(spark):
    plan = spark.range(10**12).select(P.permute(F.col("id"), 10**12)).where("id % 4096 = 7")._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan
