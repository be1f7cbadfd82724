"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations alone.

Every shard stands at ``vnodes`` points of a ring.  A document's key is the hash of its text, so equal texts
start at the same point; its shard is the one at the next point clockwise.  A shard takes at most
ceil(n / shards) rows (floor for the last ones, so that the sum is n): rows that find their shard full go on
clockwise, first come first served, to the next point whose shard has room.  Loads therefore differ by one
row at most, and only the overflow moves.

Rows are never compared one by one.  The arcs between points are cut into cells by the hash; a cell with more
than ``target`` rows or a thousandth of all, such as a text that a third of all rows share, is salted by ``doc_id``.  Counts per
arc (shards * vnodes rows, a fixed number) decide how many rows each arc keeps and which stretches of its
overflow go where; a row only needs its rank in its arc to find its shard and slot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SHARDS = 16
VNODES = 48
# Bits of the ring; positions fit into a long.
RING_BITS = 32
CELL_BITS = 12
# Rows that are ranked by one task: at most TARGET, and one in PARTS of all.
TARGET, PARTS = 500_000, 1024


def ring(docs: DataFrame, shards: int, vnodes: int) -> DataFrame:
    """One row (arc, point, shard) per virtual node, in ring order; equal points are ordered by shard."""
    spark = docs.sparkSession
    nodes = spark.range(shards * vnodes).select(
        (F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).alias("vnode")
    )
    point = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit("node"), "shard", "vnode")), 1, RING_BITS // 4), 16, 10)
    rank = F.row_number().over(W.orderBy("point", "shard", "vnode")) - 1
    return nodes.withColumn("point", point.cast("long")).select(rank.cast("int").alias("arc"), "point", "shard")


def _key(text: Column) -> Column:
    """A text's place on the ring."""
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, RING_BITS // 4), 16, 10).cast("long")


def _allocate(arcs: DataFrame, shards: int) -> DataFrame:
    """From (arc, shard, rows) the pieces of every arc: rows from rank ``lo`` on go to ``shard`` from ``slot`` on.

    One fold over two turns of the ring.  Its state is what room each shard has left, the rows that wait
    (first in, first out; they are numbered from 0 in the order in which they begin to wait) and the log.
    """
    log_type = "struct<arc:int,shard:int,own:long,own_slot:long,wait_from:long,wait:long,take_from:long,take:long,take_slot:long>"
    room = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: (F.floor(F.col("n") / shards) + F.when(s < F.col("n") % shards, 1).otherwise(0)).cast("long"),
    )
    start = F.struct(
        room.alias("room"), room.alias("cap"), F.lit(0).cast("long").alias("joined"), F.lit(0).cast("long").alias("left"),
        F.array().cast(f"array<{log_type}>").alias("log"),
    )

    def step(state: Column, node: Column) -> Column:
        free = F.element_at(state["room"], node["shard"] + 1)
        own = F.least(free, node["rows"])
        wait = node["rows"] - own
        take = F.least(free - own, state["joined"] - state["left"])
        full = F.element_at(state["cap"], node["shard"] + 1)
        entry = F.struct(
            node["arc"].alias("arc"), node["shard"].alias("shard"), own.alias("own"), (full - free).alias("own_slot"),
            state["joined"].alias("wait_from"), wait.alias("wait"), state["left"].alias("take_from"), take.alias("take"),
            (full - free + own).alias("take_slot"),
        ).cast(log_type)
        after = F.transform(state["room"], lambda r, k: F.when(k == node["shard"], r - own - take).otherwise(r))
        return F.struct(
            after.alias("room"), state["cap"].alias("cap"), (state["joined"] + wait).alias("joined"), (state["left"] + take).alias("left"),
            F.when((own > 0) | (wait > 0) | (take > 0), F.concat(state["log"], F.array(entry))).otherwise(state["log"]).alias("log"),
        )

    first = F.array_sort(F.collect_list(F.struct("arc", "shard", "rows")))
    second = F.transform("turn", lambda x: F.struct(x["arc"].alias("arc"), x["shard"].alias("shard"), F.lit(0).cast("long").alias("rows")))
    log = (
        arcs.agg(first.alias("turn"), F.sum("rows").alias("n"))
        .select("n", F.concat("turn", second).alias("turns"))
        .select(F.aggregate("turns", start, step)["log"].alias("log"))
    )
    # A stretch of waiting rows of an arc meets the stretches that shards took from the queue.
    takes = F.filter("log", lambda x: x["take"] > 0)
    spread = log.select(takes.alias("takes"), F.explode("log").alias("e"))

    def met(t: Column) -> Column:
        at = F.greatest(t["take_from"], F.col("e.wait_from"))
        return F.struct(
            (F.col("e.own") + at - F.col("e.wait_from")).alias("lo"), t["shard"].alias("shard"), (t["take_slot"] + at - t["take_from"]).alias("slot")
        )

    meets = F.filter(
        "takes",
        lambda t: (t["take_from"] < F.col("e.wait_from") + F.col("e.wait")) & (t["take_from"] + t["take"] > F.col("e.wait_from")),
    )
    own = F.when(F.col("e.own") > 0, F.array(F.struct(F.lit(0).cast("long").alias("lo"), F.col("e.shard").alias("shard"), F.col("e.own_slot").alias("slot"))))
    kind = "array<struct<lo:long,shard:int,slot:long>>"
    pieces = F.concat(F.coalesce(own, F.array()).cast(kind), F.when(F.col("e.wait") > 0, F.transform(meets, met)).otherwise(F.array()).cast(kind))
    return spread.select(F.col("e.arc").alias("arc"), pieces.alias("pieces")).where(F.size("pieces") > 0)


def assign(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, target: int = TARGET) -> DataFrame:
    """Add ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard) to ``docs`` (doc_id, text).

    Law ``rows``: shard sizes differ by one row at most.  A null text counts as empty, a null ``doc_id``
    sorts first, rows that repeat take places of their own; an empty table stays empty.  Other columns of
    ``docs`` are dropped.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    rows = docs.select(
        "doc_id",
        size.cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        _key(F.col("text")).alias("key"),
    )
    nodes = ring(docs, shards, vnodes)
    points = nodes.agg(F.array_sort(F.collect_list("point")).alias("points")).scalar()
    # The next point clockwise: as many points as lie before the key (beyond the last it is the first).
    # Looked up once for each cell of the ring; only the points inside a key's own cell are compared.
    shift = RING_BITS - CELL_BITS
    cells = (
        docs.sparkSession.range(1 << CELL_BITS)
        .withColumn("points", points)
        .select(
            F.col("id").alias("cell"),
            F.size(F.filter("points", lambda p: p < F.shiftleft(F.col("id"), shift))).alias("before"),
            F.filter("points", lambda p: F.shiftright(p, shift) == F.col("id")).alias("inside"),
        )
    )
    inside = F.aggregate("inside", F.col("before"), lambda a, p: a + F.when(p < F.col("key"), 1).otherwise(0))
    placed = (
        rows.withColumn("cell", F.shiftright("key", shift))
        .join(F.broadcast(cells), "cell")
        .withColumn("arc", F.pmod(inside, F.lit(shards * vnodes)).cast("int"))
        .drop("before", "inside")
    )
    counts = placed.groupBy("arc", "cell").agg(F.count(F.lit(1)).alias("rows"))
    arcs = nodes.join(counts.groupBy("arc").agg(F.sum("rows").alias("rows")), "arc", "left").select(
        "arc", "shard", F.coalesce("rows", F.lit(0)).cast("long").alias("rows")
    )
    pieces = _allocate(arcs, shards)
    # Ranks in an arc: cell after cell, part after part; hot cells have several parts.  There are at most
    # PARTS hot cells, or one for each ``target`` rows.
    total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).scalar()
    limit = F.least(F.lit(target), F.ceil(total / PARTS))
    hot = counts.withColumn("limit", limit).where("rows > limit").select(
        "arc", "cell", F.ceil(F.col("rows") / F.col("limit")).cast("int").alias("parts")
    )
    dealt = placed.join(F.broadcast(hot), ["arc", "cell"], "left").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.coalesce("parts", F.lit(1))).cast("int")
    )
    sizes = dealt.groupBy("arc", "cell", "part").agg(F.count(F.lit(1)).alias("rows"))
    before = sizes.withColumn(
        "base", F.sum("rows").over(W.partitionBy("arc").orderBy("cell", "part")) - F.col("rows")
    ).drop("rows")
    local = F.row_number().over(W.partitionBy("arc", "cell", "part").orderBy("key", "text_crc32", "doc_id", "size")) - 1
    ranked = dealt.withColumn("local", local).join(before, ["arc", "cell", "part"]).withColumn("rank", F.col("base") + F.col("local"))
    mine = F.element_at(F.filter("pieces", lambda p: p["lo"] <= F.col("rank")), -1)
    return (
        ranked.join(F.broadcast(pieces), "arc")
        .withColumn("to", mine)
        .select("doc_id", "size", "text_crc32", F.col("to.shard").alias("shard"), (F.col("to.slot") + F.col("rank") - F.col("to.lo")).alias("slot"))
    )
