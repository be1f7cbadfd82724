"""Training-log queries.  Runs are the event types, fifty events make a step."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import trainlog as a
from corpusloom.plans.registry import query, r6, table
from corpusloom.session import stage_path
from corpusloom.sources import io

MET = """met as (select event_type as run, event_id // 50 as step, user_id % 4 as rank, 'd' || (user_id % 5) as dataset,
    'layer' || (user_id % 6) as layer, ts, value, (props->>'k')::bigint as k from events)"""
STEPS = f"{MET}, st as (select run, step, max(ts) as ts, sum(value * k) / sum(k) as loss, sum(k)::bigint as n_tokens, count(*) as n from met group by 1, 2)"


def _metrics(spark, sf):
    ev = table(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.get_json_object("props", "$.k").cast("long")
    return ev.select(
        F.col("event_type").alias("run"),
        F.floor(F.col("event_id") / 50).alias("step"),
        (F.col("user_id") % 4).alias("rank"),
        F.concat(F.lit("d"), F.col("user_id") % 5).alias("dataset"),
        F.concat(F.lit("layer"), F.col("user_id") % 6).alias("layer"),
        "ts",
        "value",
        (F.col("value") * k).alias("loss_sum"),
        k.alias("n_tokens"),
    )


LOG = f"""lg as (select *, rank() over (partition by run order by step, k) - 1 as line_no from (
    select run, step, 0 as k, n_tokens, n from st union all select run, step, 1, n_tokens, n from st where step % 10 = 0))"""


def _write_log(st, noise=False):
    """One plain log file per run, as a launcher leaves it, in a folder named after the run."""
    n = F.col("n_tokens")
    seconds = F.concat(F.floor(n / 1000), F.lit("."), F.lpad((n % 1000).cast("string"), 3, "0"))
    timing = F.concat(
        F.lit("iteration "), "step", F.lit(" | Step Time : "), seconds, F.lit("s | GPU utilization: "), n, F.lit(".25TFLOP/s/GPU")
    )
    memory = F.concat(F.lit("rank 0 | mem-allocated-gigabytes: "), "n", F.lit(".5 GB"))
    parts = [timing, F.when(F.col("step") % 10 == 0, memory)]
    if noise:
        parts += [F.lit(""), F.lit("saving checkpoint"), F.lit("mem-allocated-gigabytes: 1.2.3")]
    path = stage_path(st.sparkSession, "train-log")
    lines = st.select(F.col("run").alias("of"), "step", F.posexplode(F.array_compact(F.array(*parts))).alias("k", "value"))
    lines.repartition("of").sortWithinPartitions("of", "step", "k").select("of", "value").write.partitionBy("of").text(path)
    return io.read_train_log(st.sparkSession, path, F.regexp_extract("file_path", r"of=([^/]+)/", 1))


def _steps(spark, sf):
    # A step without counted tokens has no finite loss: its quotient is NaN or infinite, as in the SQL, and no error.
    loss = F.coalesce(F.try_divide(F.sum("loss_sum"), F.sum("n_tokens")), F.signum(F.sum("loss_sum")) * float("inf"))
    return _metrics(spark, sf).groupBy("run", "step").agg(
        F.max("ts").alias("ts"),
        loss.alias("loss"),
        F.sum("n_tokens").alias("n_tokens"),
        F.count("*").alias("n"),
    )


@query(
    "a1_step_summary",
    f"""with {STEPS}, f as (select run, min(step) as f from st group by 1),
    m as (select run, arg_min(n, step) + 0.5::double as mem_gb from st where step % 10 = 0 group by 1)
    select run, count(*) as n_steps, round(avg(n_tokens / 1000::double), 6) as step_time, round(avg(n_tokens + 0.25::double), 6) as tflops,
           any_value(mem_gb) as mem_gb
    from st join f using (run) left join m using (run) where step > f group by 1""",
)
def a1(spark, sf):
    # The log is written as text first, one file per run, and read back.
    out = a.step_summary(_write_log(_steps(spark, sf), noise=True))
    return out.withColumns({"step_time": r6("step_time"), "tflops": r6("tflops")})


@query(
    "s10_read_train_log",
    f"""with {STEPS}, {LOG} select run, line_no, case when k = 0 then n_tokens / 1000::double end as step_time,
        case when k = 0 then n_tokens + 0.25::double end as tflops, case when k = 1 then n + 0.5::double end as mem_gb from lg""",
)
def s10(spark, sf):
    return _write_log(_steps(spark, sf))


@query("a2_token_weighted_loss", f"with {STEPS} select run, step, round(loss, 6) as loss, n_tokens from st")
def a2(spark, sf):
    return a.weighted_loss(_metrics(spark, sf), "run", "step").withColumn("loss", r6("loss"))


@query(
    "a2_custom_metric",
    f"with {MET} select run, step, round(max(value) - min(value), 6) as spread from met group by 1, 2",
)
def a2_custom(spark, sf):
    return a.step_metric(_metrics(spark, sf), F.round(F.max("value") - F.min("value"), 6), "spread", "run", "step")


@query(
    "a3_rolling_throughput",
    f"""with {STEPS}, e as (select run, step, (epoch_us(ts) - epoch_us(lag(ts, 20) over (partition by run order by step))) / 1000000::double as s
         from st),
    b as (select run, step, case when s > 0 then 20 / s end as b from e)
    select run, step, round(b, 6) as batches_per_sec, round(b * 64, 6) as samples_per_sec, round(b * 64 * 2048, 6) as tokens_per_sec,
           round(b / 8, 6) as device_batches_per_sec, round(b * 64 / 8, 6) as device_samples_per_sec,
           round(b * 64 * 2048 / 8, 6) as device_tokens_per_sec from b""",
)
def a3(spark, sf):
    out = a.rolling_throughput(_steps(spark, sf), 64, 2048, 8)
    return out.select("run", "step", *[r6(c).alias(c) for c in out.columns[2:]])


@query(
    "a4_loss_alerts",
    f"""with {STEPS}, x as (select run, step, case when step % 37 = 5 then 'NaN'::double when step % 41 = 7 then 'Infinity'::double else loss end as loss from st),
    w as (select *, max(case when not isnan(loss) and not isinf(loss) then loss end) over (
            partition by run order by step range between 30 preceding and 1 preceding) as trailing_max from x)
    select run, step, round(trailing_max, 6) as trailing_max,
           case when isnan(loss) then 'nan' when isinf(loss) then 'inf' else 'spike' end as alert
    from w where isnan(loss) or isinf(loss) or loss > 1.1 * trailing_max""",
)
def a4(spark, sf):
    loss = F.when(F.col("step") % 37 == 5, float("nan")).when(F.col("step") % 41 == 7, float("inf")).otherwise(F.col("loss"))
    steps = _steps(spark, sf).select("run", "step", loss.alias("loss"))
    out = a.loss_alerts(steps, 1.1, 30, block=40)
    return out.select("run", "step", r6("trailing_max").alias("trailing_max"), "alert")


VAL = f"""{MET}, pd as (select run, step, dataset, sum(value * k) / nullif(sum(k), 0) as loss from met group by 1, 2, 3),
  val as (select * from pd union all select run, step, null, avg(loss) from pd group by 1, 2)"""


def _validation(spark, sf):
    return a.validation_by_dataset(_metrics(spark, sf))


@query("a5_validation_by_dataset", f"with {VAL} select run, step, dataset, round(loss, 9) as loss from val")
def a5(spark, sf):
    return _validation(spark, sf).withColumn("loss", F.round("loss", 9))


@query(
    "a6_domain_collapse",
    f"""with {VAL}, ev as (select *, dense_rank() over (partition by run order by step) as e from val),
    c as (select x.run, x.step, x.dataset, x.loss, x.loss - y.loss as change from ev x join ev y
          on x.run = y.run and x.e = y.e + 1 and x.dataset is not distinct from y.dataset)
    select c.run, c.step, c.dataset, round(c.loss, 9) as loss, round(c.change, 9) as change, round(t.change, 9) as mean_change
    from c join c t on t.run = c.run and t.step = c.step and t.dataset is null
    where c.dataset is not null and c.change > 0 and t.change < 0""",
)
def a6(spark, sf):
    out = a.domain_collapse(_validation(spark, sf))
    return out.withColumns({c: F.round(c, 9) for c in ("loss", "change", "mean_change")})


@query(
    "a6_stagnating",
    f"""with {VAL}, ev as (select *, dense_rank() over (partition by run order by step) as e from val where dataset is not null),
    w as (select *, min(loss) over z as best_before, count(*) over z as seen from ev
          window z as (partition by run, dataset order by e range between 8 preceding and 1 preceding))
    select run, step, dataset, round(loss, 9) as loss, round(best_before, 9) as best_before from w where seen >= 8 and loss >= best_before""",
)
def a6_stagnating(spark, sf):
    out = a.stagnating(_validation(spark, sf), 8, block=40)
    return out.withColumns({c: F.round(c, 9) for c in ("loss", "best_before")})


SEEN = f"{STEPS}, sn as (select *, (sum(n_tokens) over (partition by run order by step))::bigint as tokens_seen from st)"


@query(
    "a7_capability_drop",
    f"""with {SEEN}, w as (select run, step, tokens_seen, 100 - loss as score, max(100 - loss) over (
            partition by run order by tokens_seen range between 6000 preceding and current row) as best from sn)
    select run, step, tokens_seen, round(score, 6) as score, round(best, 6) as best, round(best - score, 6) as drop
    from w where best - score > 20""",
)
def a7(spark, sf):
    seen = a.running_tokens(_steps(spark, sf), block=40)
    out = a.capability_drop(seen.select("run", "step", "tokens_seen", (100 - F.col("loss")).alias("score")), 20, 6000)
    return out.withColumns({c: r6(c) for c in ("score", "best", "drop")})


@query(
    "a8_throughput_drop",
    f"""with {STEPS}, w as (select run, step, n_tokens::double as tflops, avg(n_tokens::double) over z as m, count(*) over z as seen from st
          window z as (partition by run order by step rows between 20 preceding and 1 preceding))
    select run, step, tflops, round(m, 6) as trailing_mean from w where seen >= 20 and tflops < (1 - 0.3::double) * m""",
)
def a8(spark, sf):
    steps = _steps(spark, sf).select("run", "step", F.col("n_tokens").cast("double").alias("tflops"))
    return a.throughput_drop(steps, block=40).withColumn("trailing_mean", r6("trailing_mean"))


@query(
    "a8_stragglers",
    f"""with {MET}, r as (select run, step, rank, max(value) as time from met group by 1, 2, 3)
    select run, step, arg_max(rank, time) as rank, max(time) as time, round(median(time), 6) as median_time,
           round(max(time) / median(time), 6) as ratio, max(time) / median(time) > 1.5 as straggler from r group by 1, 2""",
)
def a8_stragglers(spark, sf):
    ranks = _metrics(spark, sf).groupBy("run", "step", "rank").agg(F.max("value").alias("time"))
    return a.stragglers(ranks).withColumns({"median_time": r6("median_time"), "ratio": r6("ratio")})


@query(
    "a9_progress",
    f"""with {STEPS}, s0 as (select run, min(ts) as t0 from st group by 1),
    h as (select run, step, (epoch_us(ts) - epoch_us(t0)) / 3600000000::double as hours, (step + 1) / 10000::double as f from st join s0 using (run))
    select run, step, (step + 1) * 64 as samples, (step + 1) * 64 * 2048 as tokens, round(hours, 6) as hours,
           round(hours / f * (1 - f), 4) as remaining_hours from h""",
)
def a9(spark, sf):
    out = a.progress(_steps(spark, sf), 10_000, 64, 2048)
    return out.withColumns({"hours": r6("hours"), "remaining_hours": F.round("remaining_hours", 4)})


@query(
    "a10_grad_health",
    f"""with {MET}, l as (select run, step, layer, max(value) / 100000 as g, (sum(k) / 10)::double as p from met where step % 13 <> 0 group by 1, 2, 3),
    s as (select run, step, sqrt(sum(g * g)) as g, sqrt(sum(p * p)) as p, median(g) as m, arg_max(layer, g) as top_layer, max(g) as top from l group by 1, 2)
    select run, step, round(g, 9) as grad_norm, round(p, 6) as param_norm, round(g / p, 9) as ratio,
           case when g / p < 1e-4 then 'vanishing' when g / p > 1e-3 then 'exploding' else 'healthy' end as status,
           top_layer, top > 2 * m as outlier from s""",
)
def a10(spark, sf):
    layers = _metrics(spark, sf).groupBy("run", "step", "layer").agg(
        (F.max("value") / 100000).alias("grad_norm"), (F.sum("n_tokens") / 10).alias("param_norm")
    ).withColumn("skipped", F.col("step") % 13 == 0)
    out = a.grad_health(layers, 1e-4, 1e-3, 2.0).drop("median_layer")
    return out.withColumns({"grad_norm": F.round("grad_norm", 9), "param_norm": r6("param_norm"), "ratio": F.round("ratio", 9)})


@query(
    "a11_loss_scale_floor",
    f"""with {STEPS}, x as (select run, step, pow(2, 16 - step % 17)::double as scale from st),
    r as (select *, coalesce(scale > lag(scale) over (partition by run order by step), true)::int as up from x),
    g as (select *, sum(up) over (partition by run order by step) as i from r)
    select run, min(step) as first_step, max(step) as last_step, max(scale) as from_scale, min(scale) as to_scale, count(*) as n_steps
    from g group by run, i having min(scale) <= 1 and max(scale) > 1""",
)
def a11(spark, sf):
    scale = F.pow(F.lit(2.0), (16 - F.col("step") % 17).cast("double"))
    return a.loss_scale_floor(_steps(spark, sf).select("run", "step", scale.alias("scale")), 1.0, block=40)


@query(
    "a12_power_per_iter",
    f"""with {SEEN}, l as (select run, step, ts, tokens_seen * 3.5::double as e from sn where step % 10 = 0),
    p as (select *, step - lag(step) over z as n, e - lag(e) over z as de, epoch_us(ts) - epoch_us(lag(ts) over z) as dt
          from l window z as (partition by run order by step)),
    d as (select run, step, de / n / 8 as j, dt / 1000000::double / n as s from p where n is not null)
    select run, step, round(j, 6) as iter_energy, round(case when s > 0 then j / s end, 6) as power from d""",
)
def a12(spark, sf):
    seen = a.running_tokens(_steps(spark, sf), block=40)
    out = a.power_per_iter(seen.withColumn("energy", F.col("tokens_seen") * 3.5), 10, 8)
    return out.withColumns({"iter_energy": r6("iter_energy"), "power": r6("power")})
