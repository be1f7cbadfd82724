"""Mixture rules and training-log analytics on literal rows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import mixing as m
from corpusloom.operators import trainlog as a
from corpusloom.sources import io

CAT = "lang string, quality string, domain string, dataset string, tokens long"


def test_temperature_and_unimax_against_the_loop(spark):
    rng = random.Random(4)
    for budget in (50.0, 900.0, 5000.0):
        sizes = {f"l{i}": rng.randrange(1, 200) for i in range(9)}
        df = spark.createDataFrame(list(sizes.items()), "lang string, tokens long")
        left, want = budget, {}
        order = sorted(sizes, key=lambda x: (sizes[x], x))
        for i, lang in enumerate(order):
            want[lang] = min(3.0 * sizes[lang], left / (len(order) - i))
            left -= want[lang]
        rows = m.unimax(df, budget, 3).collect()
        assert all(r.allocation == pytest.approx(want[r.lang]) and r.epochs <= 3 + 1e-9 for r in rows)
        assert rows[0].unallocated == pytest.approx(max(left, 0), abs=1e-6)
    two = spark.createDataFrame([("a", 50), ("b", 1)], "lang string, tokens long")
    w = {r.lang: r.weight for r in m.temperature(two, 0.3).collect()}
    assert w["a"] / w["b"] == pytest.approx(50**0.3)


def _catalog(spark, rows):
    return spark.createDataFrame([(x[0], x[1], "mixed", x[2], x[3]) for x in rows], CAT)


def _cascade(spark, rows, ratios, cc):
    return m.cascade(_catalog(spark, rows), spark.createDataFrame(list(ratios.items()), "lang string, ratio double"),
                     spark.createDataFrame(list(cc.items()), "lang string, cc_ratio double"))


def test_cascade_rules(spark):
    rows = [("EN", "CC", "EN_a", 100), ("EN", "CC", "EN_b-head-25", 20), ("EN", "CC", "EN_b-middle-50", 50),
            ("EN", "CC", "EN_b-tail-25", 10), ("EN", "nonCC", "EN_c", 30), ("EN", "nonCC", "EN_d", 10),
            ("KM", "CC", "KM_a", 98), ("KM", "nonCC", "KM_w", 2), ("JV", "CC", "JV_a", 5)]
    got = {r.dataset: r.weight for r in _cascade(spark, rows, {"EN": 1.0, "KM": 0.5, "JV": 0.0}, {"EN": 0.8}).collect()}
    en = 1 / 1.5
    assert got["EN_a"] == pytest.approx(en * 0.8 / 2) and got["EN_c"] == pytest.approx(en * 0.2 * 0.75)
    half, delta = en * 0.4, 0.5 * 10 / 20
    assert got["EN_b-head-25"] == pytest.approx(half * 0.25 * (1 + delta))
    assert got["EN_b-middle-50"] == pytest.approx(half * 50 / 80)
    assert got["EN_b-tail-25"] == pytest.approx(half * 0.125 - half * 0.25 * delta)
    assert got["KM_a"] == pytest.approx(0.98 / 3) and got["KM_w"] == pytest.approx(0.02 / 3)
    assert "JV_a" not in got and sum(got.values()) == pytest.approx(1)


# (head, middle, tail) -> share moved; the first two are published worked cases.
@pytest.mark.parametrize("h,mid,t,delta", [
    (2_057_048_857, 4_585_093_464, 1_775_548_351, 0.4316),
    (6_056_890_592, 20_988_635_635, 9_749_002_919, 0.6096),
    (10, 10, 10, 0.5), (10, 10, 100, 1.0), (0, 10, 10, 0.0)])
def test_tail_to_head_is_budget_neutral(spark, h, mid, t, delta):
    rows = [("X", "CC", "X_s-head-25", h), ("X", "CC", "X_s-middle-50", mid), ("X", "CC", "X_s-tail-25", t)]
    got = {r.dataset: r.weight for r in _cascade(spark, rows, {"X": 1.0}, {}).collect()}
    total = h + mid + t
    assert sum(got.values()) == pytest.approx(1) and min(got.values()) >= -1e-12
    assert got["X_s-head-25"] == pytest.approx(h / total * (1 + delta), rel=1e-3)


def test_missing_quality_is_reported_not_hidden(spark):
    w = _cascade(spark, [("X", "nonCC", "X_a", 5), ("Y", "CC", "Y_a", 5)], {"X": 0.5, "Y": 0.5}, {"X": 0.6})
    r = m.check_sum(w).first()
    assert not r.sums_to_one and r.total == pytest.approx(0.7)
    out = io.write_blend(w).first()
    assert not out.ok and out.blend is None


def test_catalog_and_sources(spark):
    tree = {"EN": {"CC": {"mixed": [{"name": "EN_a", "n": 5}]}, "nonCC": {"mixed": [{"name": "EN_b", "n": 7}]}}, "ZZ": {}}
    cat = io.read_catalog(spark, tree, "n").cache()
    assert sorted(tuple(r) for r in cat.collect()) == [("EN", "CC", "mixed", "EN_a", 5), ("EN", "nonCC", "mixed", "EN_b", 7)]
    with pytest.raises(ValueError, match="EN_b"):
        io.check_sources(cat, cat.where("quality = 'CC'"))


def test_blend_forms(spark, tmp_path):
    read = lambda **kw: [tuple(r) for r in io.read_blend(spark, **kw).orderBy("split", "position").collect()]
    want = [("all", 0, "/a", 0.8), ("all", 1, "/b", 0.2)]
    assert read(blend=[0.8, "/a", "0.2", "/b"]) == want and read(blend=(["/a", "/b"], [0.8, 0.2])) == want
    (tmp_path / "x.txt").write_text("0.8 /a\n0.2 /b\n")
    assert read(blend=str(tmp_path / "x.txt")) == want
    assert read(blend=["/a", "/b"]) == [("all", 0, "/a", None), ("all", 1, "/b", None)]
    (tmp_path / "s.json").write_text('{"train": [[0.7, "/a"], [0.3, "/b"]], "valid": "1 /v", "test": null}')
    assert read(per_split=str(tmp_path / "s.json")) == [("train", 0, "/a", 0.7), ("train", 1, "/b", 0.3), ("valid", 0, "/v", 1.0)]
    with pytest.raises(ValueError):
        io.read_blend(spark, blend=["/a"], per_split={"train": []})
    w = spark.createDataFrame([("/a", 0.75), ("/b", 0.25), ("/z", 0.0)], "dataset string, weight double")
    again = io.explode_blend(io.write_blend(w)).collect()
    assert sorted((r.dataset, r.weight) for r in again) == [("/a", 0.75), ("/b", 0.25)]


def test_replay_reaches_its_share(spark):
    new = spark.createDataFrame([(i, "text", 100) for i in range(75)], "doc_id long, kind string, n_tokens long")
    old = spark.createDataFrame([(1000 + i, "math" if i % 2 else "text", 10) for i in range(2000)], new.schema)
    parts = spark.createDataFrame([("text", 0.8), ("math", 0.2)], "kind string, part double")
    got = m.replay_mix(new, old, 0.25, parts).groupBy("origin", "kind").agg(F.sum("n_tokens").alias("t")).collect()
    t = {(r.origin, r.kind): r.t for r in got}
    assert t["new", "text"] == 7500 and t["replay", "text"] == 2000 and t["replay", "math"] == 500


def test_replay_bands(spark):
    rows = spark.createDataFrame([(0.005, "same_domain"), (0.05, "new_domain"), (0.4, "new_language"), (0.1, "?")], "r double, s string")
    got = [x[0] for x in rows.select(m.replay_check(F.col("r"), F.col("s"))).collect()]
    assert got == ["below", "ok", "above", None]


def test_regmix_finds_the_cheap_corner(spark):
    draws = m.dirichlet(spark, 64, [1.0, 1.0, 1.0], seed=3, parts=2)
    assert draws.where("abs(aggregate(mix, 0D, (a, x) -> a + x) - 1) > 1e-9").count() == 0
    again = m.dirichlet(spark, 64, [1.0, 1.0, 1.0], seed=3, parts=5)
    assert draws.exceptAll(again).isEmpty()
    proxies = draws.withColumn("loss", 3 * F.col("mix")[0] + F.col("mix")[1] - F.col("mix")[2])
    best = m.regmix(proxies, m.dirichlet(spark, 500, [1.0, 1.0, 1.0], seed=4), top=3).collect()
    assert len(best) == 3 and all(r.mix[2] > 0.7 for r in best)


# ---- logs --------------------------------------------------------------------------------------
def test_step_summary_drops_the_first_line(spark, tmp_path):
    step = "iter Step Time : {}s | GPU utilization: {}TFLOP/s"
    for run, lines in {
        "a": [step.format(99, 1), "mem-allocated-gigabytes: 73.65 x", "", step.format(4.0, 200), "noise: 1.2.3",
              step.format(4.2, 202), "mem-allocated-gigabytes: 80"],
        "one": [step.format(5, 5)], "none": ["nothing", "Step Time : s.. GPU utilization: "],
    }.items():
        (tmp_path / run).mkdir()
        (tmp_path / run / "train.log").write_text("\n".join(lines))
    paths = [str(tmp_path / run) for run in ("a", "one", "none")]
    rows = io.read_train_log(spark, paths)
    assert {r.run.split("/")[-2] for r in rows.collect()} == {"a", "one", "none"}
    assert [r.line_no for r in rows.where("mem_gb > 0").orderBy("line_no").collect()] == [1, 6]
    got = {r.run.split("/")[-2]: r for r in a.step_summary(rows).collect()}
    assert (got["a"].n_steps, got["a"].mem_gb) == (2, 73.65)
    assert got["a"].step_time == pytest.approx(4.1) and got["a"].tflops == pytest.approx(201)
    assert got["one"].step_time is None and got["none"].n_steps == 0 and got["none"].step_time is None


def test_masked_loss_case(spark):
    losses = [2.0, 1.5, 3.0, 0.5, 1.0, 4.0, 9.0, 9.0]
    df = spark.createDataFrame([("r", x, float(i < 6)) for i, x in enumerate(losses)], "run string, loss double, mask double")
    r = a.masked_loss(df, "run").first()
    assert r.loss == pytest.approx(sum(losses[:6]) / 6) and r.n_tokens == 6


def _steps(spark, seconds):
    t0 = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([("r", i, t0 + dt.timedelta(seconds=s)) for i, s in enumerate(seconds)],
                                 "run string, step long, ts timestamp")


def test_throughput_guards(spark):
    rows = a.rolling_throughput(_steps(spark, [0, 2, 4, 4, 3, 10]), 10, 100, 2, window=2).orderBy("step").collect()
    assert [r.batches_per_sec for r in rows] == [None, None, 0.5, 1.0, None, pytest.approx(1 / 3)]
    assert rows[2].tokens_per_sec == 500 and rows[2].device_tokens_per_sec == 250


def test_gaps_in_the_log_do_not_count(spark):
    t0 = dt.datetime(2024, 1, 1)
    kept = [s for s in range(0, 60, 2) if s % 10]
    df = spark.createDataFrame([("r", s, t0 + dt.timedelta(seconds=s)) for s in kept], "run string, step long, ts timestamp")
    rows = a.rolling_throughput(df, 1, 1, 1, window=3).orderBy("step").collect()
    want = [None if k < 3 else 3 / (kept[k] - kept[k - 3]) for k in range(len(kept))]
    assert [r.batches_per_sec for r in rows] == [None if w is None else pytest.approx(w) for w in want]
    flops = spark.createDataFrame([("r", s, 10.0 if k != 9 else 5.0) for k, s in enumerate(kept)], "run string, step long, tflops double")
    assert [r.step for r in a.throughput_drop(flops, window=6, block=7).collect()] == [kept[9]]
    losses = [("r", s, d, x) for s, d, x in [(0, "a", 1.0), (0, "b", 5.0), (100, "a", 1.5), (100, "b", 3.0), (300, "a", 1.4), (300, "b", 3.0)]]
    val = spark.createDataFrame(losses, "run string, step long, dataset string, loss double")
    mean = val.groupBy("run", "step").agg(F.avg("loss").alias("loss")).withColumn("dataset", F.lit(None).cast("string"))
    got = a.domain_collapse(val.unionByName(mean)).collect()
    assert [(r.step, r.dataset, r.change) for r in got] == [(100, "a", 0.5)]
    assert [(r.step, r.dataset) for r in a.stagnating(val, 1).orderBy("step").collect()] == [(100, "a"), (300, "b")]


def test_alerts(spark):
    xs = [1.0, 2.0, float("nan"), 19.0, 21.0, float("inf"), 1.0, 250.0]
    df = spark.createDataFrame([("r", i, x) for i, x in enumerate(xs)], "run string, step long, loss double")
    got = [(r.step, r.alert) for r in a.loss_alerts(df, block=3, window=4).orderBy("step").collect()]
    # 21 is below 10 x 19; 250 is above 10 x 21, the infinite value does not count.
    assert got == [(2, "nan"), (5, "inf"), (7, "spike")]


def test_scale_floor_and_power(spark):
    scales = [8, 8, 4, 2, 1, 1, 4, 2, 2, 1]
    df = spark.createDataFrame([("r", i, float(s)) for i, s in enumerate(scales)], "run string, step long, scale double")
    got = [(r.first_step, r.last_step, r.from_scale) for r in a.loss_scale_floor(df, 1.0, block=2).orderBy("first_step").collect()]
    assert got == [(0, 5, 8.0), (6, 9, 4.0)]
    steps = _steps(spark, [i * 2 for i in range(6)]).withColumn("energy", F.col("step") * 600.0)
    p = a.power_per_iter(steps, 2, 4).orderBy("step").collect()
    assert [(r.step, r.iter_energy, r.power) for r in p] == [(2, 150.0, 75.0), (4, 150.0, 75.0)]


def test_progress(spark):
    r = a.progress(_steps(spark, [0, 3600]), 4, 8, 16).orderBy("step").collect()[1]
    assert (r.samples, r.tokens, r.hours) == (16, 256, 1.0) and r.remaining_hours == pytest.approx(1.0)


def test_grad_health_skips_and_outlier(spark):
    rows = [("r", 0, "a", 3.0, 400.0, False), ("r", 0, "b", 4.0, 300.0, False), ("r", 1, "a", 9.0, 1.0, True)]
    got = a.grad_health(spark.createDataFrame(
        rows, "run string, step long, layer string, grad_norm double, param_norm double, skipped boolean")).collect()
    assert len(got) == 1 and got[0].grad_norm == 5.0 and got[0].ratio == pytest.approx(0.01) and got[0].top_layer == "b"
