"""Exact cosine neighbours by pivots and the triangle inequality, across the whole table.

Between unit vectors, cosine similarity of at least ``1 - eps`` is a distance of at most ``r = sqrt(2 * eps)``.
Vectors go to the cell of their nearest pivot.  A neighbour x of y with nearest pivot p lies at most r from y, so y
can be needed in the cell of p only if it is no more than 2 r farther from p than from its own pivot; there, a copy of y
stands.  Inside a cell, the distances to the pivot of two neighbours differ by at most r: the cell is cut
into bands of that width, and only a band and the next one meet, in blocks of bounded size.  Where the cells and bands
rule out so little that more copies would travel than with all vectors in one cell, all are in one.

Equal vectors are one from the start.  Tasks return the lowest neighbour of each vector, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.skew import TARGET_ROWS, skew_join
from corpusloom.session import materialize

PIVOTS = 64
# Bytes of the vectors of a block: a task holds two blocks, and a vector travels as often as there are blocks to meet.
BLOCK_BYTES = 8 << 20
SLACK = 1e-6


def unit_rows(vectors: list[bytes]) -> np.ndarray:
    m = np.stack([np.frombuffer(v) for v in vectors])
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def distances(u: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (u @ pivots.T), 0))


def places(u: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, own, distance to the cell's pivot) of every place where a vector stands."""
    d = distances(u, pivots)
    own = d.argmin(1)
    near = d[np.arange(len(d)), own]
    row, cell = np.nonzero(d <= near[:, None] + 2 * radius + SLACK)
    return row, cell, own[row] == cell, d[row, cell]


def _placer(pivots: np.ndarray, radius: float):
    width = max(radius, SLACK) + SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            row, cell, own, d = places(unit_rows(b.column("vector").to_pylist()), pivots, radius)
            at = pa.array(row)
            cols = [b.column("id").take(at), pa.array(cell.astype(np.int32)), pa.array(np.floor(d / width).astype(np.int32)), pa.array(own), b.column("vector").take(at)]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "cell", "band", "own", "vector"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors with a direction, as bytes."""
    for b in batches:
        kept, out = [], []
        for k, v in enumerate(b.column("vector").to_pylist()):
            x = np.array([np.nan if y is None else y for y in v], np.float64)
            if len(x) and np.isfinite(x).all() and x.any():
                kept.append(k)
                out.append(x.tobytes())
        yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(kept, pa.int64())), pa.array(out, pa.binary())], names=["id", "vector"])


def _comparer(eps: float, kind: pa.DataType):
    def run(table: pa.Table) -> pa.Table:
        ids = np.array(table.column("id").to_pylist())
        order = np.argsort(ids, kind="stable")
        left, own = (np.asarray(table.column(c))[order] for c in ("left", "own"))
        u = unit_rows([table.column("vector")[int(k)].as_py() for k in order])
        ids, out = ids[order], []
        rows, cols = np.flatnonzero(left), np.flatnonzero(~left)
        if not len(cols):
            rows = cols = np.arange(len(ids))  # a block with itself
        for a in range(0, len(rows), 512):
            part = rows[a : a + 512]
            # Two copies need not be compared: each of them meets the other in its own cell.
            close = (u[part] @ u[cols].T >= 1.0 - eps) & (own[part][:, None] | own[cols][None, :])
            for one, two, near in ((part, cols, close), (cols, part, close.T)):
                first = ids[two[near.argmax(1)]]
                hit = near.any(1) & (first < ids[one])
                out += zip(ids[one[hit]].tolist(), first[hit].tolist())
        a, b = zip(*out) if out else ((), ())
        return pa.table({"id": pa.array(a, kind), "match": pa.array(b, kind)})

    return run


def copies(rows: dict[tuple[int, int], int], block: int) -> int:
    """How many vectors travel to blocks if that many stand in each (cell, band)."""
    blocks = {k: -(-n // block) for k, n in rows.items()}
    return sum(n * sum(blocks.get((c, b + step), 0) for step in (-1, 0, 1)) for (c, b), n in rows.items())


def matches(
    df: DataFrame, eps: float, vid: str = "vec_id", vec: str = "embedding", pivots: int = PIVOTS, block: int | None = None, target: int = TARGET_ROWS
) -> DataFrame:
    """(vid, match): for every vector with a neighbour of lower id, the lowest one.

    A neighbour has cosine similarity of at least ``1 - eps``.  Vectors that are null, empty, zero, or hold a value that
    is no number have none.  ``pivots`` vectors, chosen by hash, reach the driver and all tasks; more of them make cells smaller.
    ``block`` is the number of vectors in a block, by default what BLOCK_BYTES holds.
    All vectors must have one length; rows without an id are left out.
    """
    kind = df.schema[vid].dataType.simpleString()
    rows = df.where(F.col(vid).isNotNull() & (F.size(vec) > 0)).select(F.col(vid).alias("id"), F.col(vec).cast("array<double>").alias("vector"))
    packed = rows.mapInArrow(_packed, f"id {kind}, vector binary").withColumn("node", F.md5("vector"))
    packed = materialize(packed, "vectors")
    nodes = packed.groupBy("node").agg(F.min("id").alias("id"), F.count("*").alias("_n"), F.any_value("vector").alias("vector"))
    nodes = materialize(nodes, "distinct-vectors")
    n_nodes = nodes.count()
    chosen = unit_rows([r["vector"] for r in nodes.orderBy("node").limit(pivots).collect()]) if n_nodes else np.zeros((1, 1))
    radius = math.sqrt(2 * eps)
    placed = nodes.select("id", "vector").mapInArrow(_placer(chosen, radius), f"id {kind}, cell int, band int, own boolean, vector binary")
    block = block or max(1, BLOCK_BYTES // (8 * chosen.shape[1]))
    sizes = materialize(placed.groupBy("cell", "band").agg(F.count("*").alias("_rows")), "cells")  # one row per pivot and band
    rows_in = {(r["cell"], r["band"]): r["_rows"] for r in sizes.collect()}
    if copies(rows_in, block) >= copies({(0, 0): n_nodes}, block):
        placed = nodes.select("id", F.lit(0).alias("cell"), F.lit(0).alias("band"), F.lit(True).alias("own"), "vector")
        sizes = nodes.groupBy(F.lit(0).alias("cell"), F.lit(0).alias("band")).agg(F.count("*").alias("_rows"))
    else:
        placed = materialize(placed, "placed")
    sizes = sizes.select("cell", "band", F.ceil(F.col("_rows") / F.lit(block)).cast("int").alias("g"))
    near = placed.join(F.broadcast(sizes), ["cell", "band"])
    near = near.join(F.broadcast(sizes.select("cell", (F.col("band") - 1).alias("band"), F.col("g").alias("g_next"))), ["cell", "band"], "left")
    near = near.join(F.broadcast(sizes.select("cell", (F.col("band") + 1).alias("band"), F.col("g").alias("g_last"))), ["cell", "band"], "left")
    near = near.withColumn("i", F.pmod(F.xxhash64("id"), F.col("g")).cast("int"))
    i, other = F.col("i"), F.col("_j")

    def with_blocks(n: str) -> DataFrame:
        return near.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col(n) - 1)))

    common = ["id", "own", "vector", "cell"]
    same = with_blocks("g").select(*common, "band", F.lit(0).alias("step"), F.least(i, other).alias("p"), F.greatest(i, other).alias("q"), (i <= other).alias("left"))
    up = with_blocks("g_next").where("g_next is not null").select(*common, "band", F.lit(1).alias("step"), i.alias("p"), other.alias("q"), F.lit(True).alias("left"))
    down = with_blocks("g_last").where("g_last is not null").select(
        *common, (F.col("band") - 1).alias("band"), F.lit(1).alias("step"), other.alias("p"), i.alias("q"), F.lit(False).alias("left")
    )
    spread = same.unionByName(up).unionByName(down)
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    found = spread.groupBy("cell", "band", "step", "p", "q").applyInArrow(_comparer(eps, arrow), f"id {kind}, match {kind}")
    found = materialize(found.groupBy("id").agg(F.min("match").alias("match")), "matches")
    # Copies of a vector have its neighbours, and the first of them as well.
    known = nodes.select("node", F.col("id").alias("_first"), "_n").join(found.withColumnRenamed("id", "_first"), "_first", "left")
    out = skew_join(packed.select("node", "id"), known, ["node"], "_n", ["id"], target)
    lowest = F.least(F.coalesce("match", "_first"), "_first")
    return out.select(F.col("id").alias(vid), lowest.alias("match")).where(F.col("match") < F.col(vid)).distinct()


def dedup(df: DataFrame, eps: float, vid: str = "vec_id", vec: str = "embedding", **options) -> DataFrame:
    """Vectors without a neighbour of lower id anywhere in the table."""
    return df.join(matches(df, eps, vid, vec, **options), vid, "left_anti")
