"""Blending datasets in a deterministic order, assigning samples to ranks, resuming and staging."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.ordering import hash_rank, prefix_sum
from corpusloom.session import materialize

SURPLUS = 0.005
# Positions of neighbouring blocks that one task runs through, each from the end of the one before.
CHAIN = 200_000


def dataset_sizes(weights: DataFrame, n: int, surplus: float = SURPLUS, have: str | None = None) -> DataFrame:
    """Samples each dataset must provide: ceil(ceil(n * w) * (1 + surplus)); ``short`` if it has fewer."""
    need = F.ceil(F.ceil(F.lit(n) * F.col("weight")) * (1 + surplus))
    out = weights.withColumn("need", need)
    return out.withColumn("short", F.col("need") > F.col(have)) if have else out


def _weight_list(weights: DataFrame) -> list[float]:
    """Weights in dataset order: one number per dataset that the caller lists in the blend."""
    rows = sorted(weights.select("dataset_id", F.col("weight").cast("double")).collect())
    if [r[0] for r in rows] != list(range(len(rows))):
        raise ValueError("dataset_id must run from 0 without gaps")
    return [r[1] for r in rows]


def _greedy(w: np.ndarray, counts: np.ndarray, first: int, last: int) -> np.ndarray:
    """Dataset of each position in [first, last): the largest deficit, lowest dataset on ties."""
    out = np.empty(last - first, dtype=np.int64)
    for i in range(first, last):
        d = int(np.argmax(w * max(i, 1) - counts))
        out[i - first] = d
        counts[d] += 1
    return out


def _likely_counts(w: np.ndarray, at: int) -> np.ndarray:
    """Counts near the exact ones at a position: rounded shares that add up to the position."""
    share = w * at
    counts = np.floor(share).astype(np.int64)
    rest = at - int(counts.sum())
    if rest > 0:
        counts[np.argsort(counts - share, kind="stable")[:rest]] += 1
    return counts


def blend_exact(
    spark: SparkSession, weights: DataFrame, n: int, block: int = 1_000_000, warm_up: int = 10_000, chain: int = CHAIN
) -> DataFrame:
    """(position, dataset_id, dataset_sample_id) in the order of the greedy largest-deficit rule.

    The rule looks sequential, but its state is only the running counts, and runs that start from
    nearly right counts soon agree with the true one.  So chains of blocks, about ``chain`` positions long (one
    block at least), run in parallel from a guess plus a warm-up; a chain whose start differs from its
    predecessor's end is run again from that end, until all of them agree.  The result is exact for any
    guess: the first chain is right, and each round makes at least one more right.  Blocks bound what a task
    holds, chains the number of tasks.
    """
    w = np.array(_weight_list(weights), dtype=np.float64)
    length = block * max(1, chain // block)
    n_chains = max(1, -(-n // length))
    fields = "chain long, start array<long>, stop array<long>"

    def blocks_of(c: int):
        end = min((c + 1) * length, n)
        for first in range(c * length, end, block):
            yield first, min(first + block, end)

    def run(batches):
        for pdf in batches:
            rows = []
            for c, given in zip(pdf["chain"], pdf["start"]):
                if given is None:
                    first = int(c) * length
                    begin = max(0, first - warm_up)
                    counts = _likely_counts(w, begin) if begin else np.zeros(len(w), dtype=np.int64)
                    _greedy(w, counts, begin, first)
                else:
                    counts = np.array(given, dtype=np.int64)
                start = counts.copy()
                for first, last in blocks_of(int(c)):
                    _greedy(w, counts, first, last)
                rows.append((int(c), start, counts))
            yield pd.DataFrame(rows, columns=["chain", "start", "stop"])

    chains = spark.range(0, n_chains, 1, min(n_chains, 10_000)).select(
        F.col("id").alias("chain"), F.lit(None).cast("array<long>").alias("start")
    )
    state = materialize(chains.mapInPandas(run, fields), "blend-chains")
    while True:
        ends = state.select((F.col("chain") + 1).alias("chain"), F.col("stop").alias("_true"))
        wrong = state.join(ends, "chain").where(F.col("start") != F.col("_true"))
        redo = materialize(wrong.select("chain", F.col("_true").alias("start")), "blend-redo")
        if redo.isEmpty():
            break
        again = redo.repartition("chain").mapInPandas(run, fields)
        state = materialize(state.join(redo.select("chain"), "chain", "left_anti").unionByName(again), "blend-chains")

    def emit(batches):
        for pdf in batches:
            for c, given in zip(pdf["chain"], pdf["start"]):
                counts = np.array(given, dtype=np.int64)
                for first, last in blocks_of(int(c)):
                    base = counts.copy()
                    chosen = _greedy(w, counts, first, last)
                    order = np.argsort(chosen, kind="stable")
                    sizes = np.bincount(chosen, minlength=len(w))
                    nth = np.empty(len(chosen), dtype=np.int64)
                    nth[order] = np.arange(len(chosen)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                    yield pd.DataFrame(
                        {
                            "position": np.arange(first, last),
                            "dataset_id": chosen,
                            "dataset_sample_id": nth + base[chosen],
                        }
                    )

    spread = state.select("chain", "start").repartition(min(n_chains, 10_000), "chain")
    return spread.mapInPandas(emit, "position long, dataset_id long, dataset_sample_id long")


def blend_scalable(weights: DataFrame, n: int, width: int = 1_000_000) -> DataFrame:
    """(position, dataset_id, dataset_sample_id): sample k of a dataset is ordered by (k + 0.5) / weight.

    About ``width`` samples fall into each stretch of ``width`` on that scale, whatever the weights, so
    stretches are even buckets: they are generated, numbered and written independently.
    """
    # One stretch beyond n, since rounding can move the last samples of a dataset past n.
    stretches = -(-n // width) + 1
    live = weights.where(F.col("weight") > 0).select("dataset_id", F.col("weight").cast("double").alias("_w"))
    cells = live.withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(stretches - 1).cast("long"))))

    def first_at(s: Column) -> Column:
        return F.greatest(F.ceil(s * width * F.col("_w") - 0.5), F.lit(0).cast("long"))

    lo, hi = first_at(F.col("_s")), first_at(F.col("_s") + 1)
    samples = (
        cells.repartition("_s")
        .where(hi > lo)
        .withColumn("dataset_sample_id", F.explode(F.sequence(lo, hi - 1)))
        .withColumn("_key", (F.col("dataset_sample_id") + 0.5) / F.col("_w"))
    )
    placed = prefix_sum(samples, "_s", ["_key", "dataset_id"], F.lit(1).cast("long"), "position")
    return placed.where(F.col("position") < n).select("position", "dataset_id", "dataset_sample_id")


def blend_samples(blend: DataFrame, samples: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Resolve (dataset_id, dataset_sample_id) to rows of ``samples``; with ``sizes`` indices wrap around."""
    rows = blend
    if sizes is not None:
        rows = rows.join(sizes.select("dataset_id", F.col("size").alias("_size")), "dataset_id").withColumn(
            "dataset_sample_id", F.col("dataset_sample_id") % F.col("_size")
        ).drop("_size")
    return rows.join(samples, ["dataset_id", "dataset_sample_id"])


def blend_drift(blend: DataFrame, weights: DataFrame, batch: int) -> DataFrame:
    """Per batch and dataset: its share of the batch, and running count minus target.

    The running count of a dataset is its highest sample number plus one, so no window is needed.
    """
    per = blend.groupBy(F.floor(F.col("position") / batch).alias("batch"), "dataset_id").agg(
        F.count("*").alias("n"), (F.max("dataset_sample_id") + 1).alias("running")
    )
    done = (F.col("batch") + 1) * batch
    return per.join(weights.select("dataset_id", "weight"), "dataset_id").select(
        "batch",
        "dataset_id",
        "n",
        "running",
        (F.col("n") / batch).alias("batch_share"),
        (F.col("running") - F.col("weight") * done).alias("drift"),
    )


def assign_ranks(samples: DataFrame, total: int, consumed: int, mbs: int, dp: int, position: str = "position") -> DataFrame:
    """Add ``batch``, ``rank`` and ``slot``: contiguous slices of each micro-batch; the last partial one is dropped."""
    step = mbs * dp
    usable = consumed + (total - consumed) // step * step
    at = F.col(position) - consumed
    return samples.where((F.col(position) >= consumed) & (F.col(position) < usable)).withColumns(
        {
            "batch": F.floor(at / step),
            "rank": F.floor((at % step) / mbs).cast("int"),
            "slot": (at % mbs).cast("int"),
        }
    )


def assign_ranks_random(
    samples: DataFrame, total: int, epoch: int, mbs: int, dp: int, data_sharding: bool = True, position: str = "position"
) -> DataFrame:
    """Add ``rank``, ``draw`` and ``batch`` from a permutation seeded by the epoch.

    With sharding each rank permutes its own contiguous bucket; without, one permutation of all
    samples is dealt out in turn.  The partial last micro-batch is left out.
    """
    bucket = total // (mbs * dp) * mbs
    used = samples.where(F.col(position) < bucket * dp)
    if data_sharding:
        ranked = used.withColumn("rank", F.floor(F.col(position) / bucket).cast("int"))
        out = hash_rank(ranked, [position], epoch, "draw", ("rank",))
    else:
        mixed = hash_rank(used, [position], epoch, "_p")
        out = mixed.withColumns({"rank": (F.col("_p") % dp).cast("int"), "draw": F.floor(F.col("_p") / dp)}).drop("_p")
    return out.withColumn("batch", F.floor(F.col("draw") / mbs))


def resume(samples: DataFrame, total: int, consumed: int, mbs: int, dp: int) -> DataFrame:
    """What an interrupted run still has to read: the suffix of the uninterrupted assignment."""
    return assign_ranks(samples, total, consumed, mbs, dp)


def consumed_samples(iteration: int, consumed: int, global_batch: int) -> int:
    """Older states hold no sample counter: it follows from the iteration."""
    return iteration * global_batch if iteration > 0 and consumed == 0 else consumed


def stage_plan(stages: list[tuple[str, int, DataFrame]], width: int = 1_000_000, sizes: DataFrame | None = None) -> DataFrame:
    """Stages one after the other, each with its own blend, sample count and sample numbers from 0.

    ``sizes`` (dataset_id, size) wraps the numbers of a dataset that a stage exhausts.
    """
    base, out = 0, None
    for name, n, weights in stages:
        part = blend_scalable(weights, n, width).select(
            F.lit(name).alias("stage"),
            (F.col("position") + base).alias("position"),
            F.col("position").alias("stage_position"),
            "dataset_id",
            "dataset_sample_id",
        )
        out = part if out is None else out.unionByName(part)
        base += n
    if sizes is None:
        return out
    return out.join(sizes.select("dataset_id", "size"), "dataset_id").withColumns(
        {
            "dataset_epoch": F.floor(F.col("dataset_sample_id") / F.col("size")),
            "dataset_sample_id": F.col("dataset_sample_id") % F.col("size"),
        }
    ).drop("size")
