"""Joins that stay balanced when one key holds a large part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one key that a single task may be given.
TARGET_ROWS = 1_000_000


def skew_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    rows: str,
    spread: list[str],
    target: int = TARGET_ROWS,
    how: str = "inner",
) -> DataFrame:
    """Join ``big`` to ``small`` (one row per key), splitting the hot keys over several tasks.

    ``small[rows]`` says how many rows of ``big`` carry the key.  Keys above ``target`` are cut into
    ``ceil(rows / target)`` parts: the list of those keys is broadcast (at most
    ``rows of big / target`` entries), ``big`` picks a part by hashing ``spread``, and ``small``
    repeats the row once per part.  Nothing is dropped and only one shuffle join is run.
    """
    parts = F.ceil(F.col(rows) / F.lit(target)).cast("int")
    hot = small.where(F.col(rows) > target).select(*keys, parts.alias("_parts"))
    left = big.join(F.broadcast(hot), keys, "left").withColumn(
        "_part", F.pmod(F.xxhash64(*spread), F.coalesce("_parts", F.lit(1))).cast("int")
    )
    right = small.withColumn("_part", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)))
    return left.join(right, [*keys, "_part"], how).drop("_part", "_parts")


def skew_lookup(
    big: DataFrame, table: DataFrame, keys: list[str], spread: list[str], target: int = TARGET_ROWS
) -> DataFrame:
    """Left join of ``big`` to a lookup ``table`` of any size, with hot keys measured on ``big``."""
    load = big.groupBy(*keys).agg(F.count("*").alias("_load"))
    return skew_join(big, load.join(table, keys, "left"), keys, "_load", spread, target, "left").drop("_load")


def salt_of(parts: int, *cols: Column | str) -> Column:
    """A stable part number in [0, parts) from column values."""
    return F.pmod(F.xxhash64(*cols), F.lit(parts)).cast("int")
