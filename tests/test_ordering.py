"""Distributed ranks, sums, quantiles and joins against plain Python, with hot groups and tiny blocks."""

from __future__ import annotations

import hashlib
import math
import random

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions import ordering as o
from corpusloom.functions import skew


def _rows(n=300, seed=3):
    rng = random.Random(seed)
    # One group holds more than a third of the rows; values repeat.
    return [(i, "hot" if rng.random() < 0.5 else f"g{rng.randrange(4)}", rng.randrange(5)) for i in range(n)]


def test_prefix_sum_by_group(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "id long, g string, v long").repartition(7)
    got = o.prefix_sum(df.withColumn("b", F.floor(F.col("id") / 10)), "b", ["id"], F.col("v"), "before", ("g",))
    want, run = {}, {}
    for i, g, v in sorted(rows):
        want[i] = run.get(g, 0)
        run[g] = run.get(g, 0) + v
    assert {r.id: r.before for r in got.collect()} == want


def test_hash_rank_is_a_permutation_by_md5(spark):
    df = spark.range(200).withColumnRenamed("id", "k")
    got = {r.k: r.r for r in o.hash_rank(df, ["k"], 9, "r", digits=1).collect()}
    order = sorted(range(200), key=lambda k: (hashlib.md5(f"9:{k}".encode()).hexdigest(), k))
    assert got == {k: i for i, k in enumerate(order)}


def test_range_rank_with_hot_group(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "id long, g string, v long")
    got = {r.id: r.r for r in o.range_rank(df, [-F.col("v"), F.col("id")], "r", ("g",), parts=5).collect()}
    for g in {r[1] for r in rows}:
        order = sorted((-v, i) for i, gg, v in rows if gg == g)
        assert [got[i] for _, i in order] == list(range(len(order)))


def test_quantiles_with_one_value_in_a_third_of_rows(spark):
    rng = random.Random(5)
    rows = [("a", 7.0 if rng.random() < 0.4 else float(rng.randrange(100))) for _ in range(500)] + [("b", 1.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r for r in o.quantiles(df, "x", {"q1": 0.25, "q3": 0.75, "top": 1.0}, ("g",)).collect()}
    for g in ("a", "b"):
        xs = sorted(x for gg, x in rows if gg == g)
        at = lambda p: xs[max(math.ceil(p * len(xs)), 1) - 1]
        assert (got[g].q1, got[g].q3, got[g].top, got[g].n) == (at(0.25), at(0.75), at(1.0), len(xs))


def test_look_back_equals_whole_window(spark):
    df = spark.createDataFrame([("r", i, (i * 37) % 101) for i in range(200) if i % 9], "run string, step long, x long")
    over = W.partitionBy("run").orderBy("step").rangeBetween(-12, -1)
    want = {r.step: r.m for r in df.withColumn("m", F.max("x").over(over)).collect()}
    spread, part = o.look_back(df, F.col("step"), 12, 15, ["run"])
    blocked = W.partitionBy(*part).orderBy("step").rangeBetween(-12, -1)
    got = spread.withColumn("m", F.max("x").over(blocked)).where("_own").collect()
    assert len(got) == len(want) and {r.step: r.m for r in got} == want


def test_skew_join_keeps_every_row(spark):
    rng = random.Random(1)
    keys = ["hot" if rng.random() < 0.6 else f"k{rng.randrange(20)}" for _ in range(400)]
    big = spark.createDataFrame(list(enumerate(keys)), "id long, k string")
    small = big.groupBy("k").agg(F.min("id").alias("lo"), F.count("*").alias("n"))
    lows = {}
    for i, k in enumerate(keys):
        lows.setdefault(k, i)
    for target in (3, 1000):
        got = skew.skew_join(big, small, ["k"], "n", ["id"], target).collect()
        assert sorted((r.id, r.lo) for r in got) == [(i, lows[k]) for i, k in enumerate(keys)]


def test_skew_lookup_is_a_left_join(spark):
    big = spark.createDataFrame([(i, "a" if i % 3 else f"x{i}") for i in range(90)], "id long, k string")
    table = spark.createDataFrame([("a", 1), ("zzz", 2)], "k string, v int")
    got = sorted((r.id, r.v) for r in skew.skew_lookup(big, table, ["k"], ["id"], target=4).collect())
    assert got == [(i, 1 if i % 3 else None) for i in range(90)]
