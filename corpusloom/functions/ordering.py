"""Global ranks, prefix sums, quantiles and look-back windows without a single-task window.

Every helper splits the order into buckets, sums per bucket (a small table), turns those sums into
bucket offsets, and finishes inside each bucket.  A group that holds a third of all rows is spread
over as many tasks as it has buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.session import materialize


def md5_key(seed: int | str, *cols: Column | str) -> Column:
    """The pseudo-random order key: hex md5 of seed and key columns, the same in every engine."""
    parts = [F.lit(str(seed))] + [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.md5(F.concat_ws(":", *parts))


def prefix_sum(
    df: DataFrame,
    bucket: str,
    order: list[str],
    value: Column,
    out: str,
    group: tuple[str, ...] = (),
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows before this one in (bucket, order), per group.

    ``bucket`` must not decrease along the order.  Without a group the offsets table has one row per
    bucket and is broadcast; with groups Spark chooses the join from its measured size.
    """
    df = df.withColumn("_v", value)
    totals = df.groupBy(*group, bucket).agg(F.sum("_v").alias("_t"))
    over = W.partitionBy(*group).orderBy(bucket) if group else W.orderBy(bucket)
    offsets = totals.select(*group, bucket, (F.sum("_t").over(over) - F.col("_t")).alias("_off"))
    local = W.partitionBy(*group, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    joined = df.join(offsets if group else F.broadcast(offsets), [*group, bucket])
    return joined.withColumn(out, F.col("_off") + F.sum("_v").over(local) - F.col("_v")).drop("_v", "_off")


def hash_rank(
    df: DataFrame,
    key: list[str],
    seed: int | str,
    out: str,
    group: tuple[str, ...] = (),
    digits: int = 4,
) -> DataFrame:
    """Add ``out``: the 0-based position of each row in a seeded pseudo-random order per group.

    Buckets are the first ``digits`` hex digits of the order key, so they are even by construction;
    ``digits`` sets their number (3 = 4,096 buckets, 4 = 65,536).
    """
    keyed = df.withColumn("_h", md5_key(seed, *key)).withColumn("_b", F.substring("_h", 1, digits))
    return prefix_sum(keyed, "_b", ["_h", *key], F.lit(1).cast("long"), out, group).drop("_h", "_b")


def range_rank(
    df: DataFrame,
    order: list[Column],
    out: str,
    group: tuple[str, ...] = (),
    weight: Column | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Add ``out``: the number (or ``weight``) of rows before this one in ``order``, per group.

    Rows are range-partitioned on (group, order) and the partition number is written with them, so
    every later reader agrees on the bucket.  ``order`` should end in a unique key.
    """
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [f"_o{i}" for i in range(len(order))]
    # An explicit direction is kept by the caller's expression (negate numbers to sort downwards).
    keyed = df.select("*", *[c.alias(a) for c, a in zip(order, names)])
    ranged = keyed.repartitionByRange(n, *group, *names).withColumn("_b", F.spark_partition_id())
    stored = materialize(ranged, "range")
    w = F.lit(1).cast("long") if weight is None else weight
    return prefix_sum(stored, "_b", names, w, out, group).drop("_b", *names)


def quantiles(
    df: DataFrame, value: str, points: dict[str, float], group: tuple[str, ...] = ()
) -> DataFrame:
    """Exact quantiles per group: the value at rank ceil(p * n), one column per named point.

    Equal values are counted together first, so a value shared by a third of the rows is one row.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_n"))
    ranked = range_rank(counted, [F.col(value)], "_before", group, F.col("_n"))
    if group:
        totals = counted.groupBy(*group).agg(F.sum("_n").alias("_total"))
        ranked = ranked.join(F.broadcast(totals), list(group))  # one row per group
    else:
        ranked = ranked.withColumn("_total", counted.agg(F.sum("_n").alias("_total")).scalar())
    cols = []
    for name, p in points.items():
        at = F.greatest(F.ceil(F.lit(p) * F.col("_total")), F.lit(1))
        hit = (F.col("_before") < at) & (at <= F.col("_before") + F.col("_n"))
        cols.append(F.max(F.when(hit, F.col(value))).alias(name))
    return ranked.groupBy(*group).agg(F.max("_total").alias("n"), *cols)


def look_back(
    df: DataFrame, position: Column, back: int, width: int, group: list[str]
) -> tuple[DataFrame, list[str]]:
    """Prepare windows that look at most ``back`` positions behind, split into blocks of ``width``.

    Each row is placed in its own block and, as a ghost (``_own`` false), in the later blocks that can
    still see it.  Window over the returned partition columns, then keep ``_own`` rows.
    """
    width = max(width, back)
    p = position.cast("long")
    first, last = F.floor(p / width), F.floor((p + back) / width)
    spread = df.withColumn("_first", first).withColumn("_block", F.explode(F.sequence(first, last)))
    return spread.withColumn("_own", F.col("_block") == F.col("_first")).drop("_first"), [*group, "_block"]
