"""Composition for long-context training: length profiles, upsampling, length quotas, window packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions.ordering import hash_rank, md5_key, quantiles
from corpusloom.functions.skew import skew_join
from corpusloom.operators.mixing import take_tokens
from corpusloom.operators.packing import materialize_samples, spans


def length_bin(n: Column, edges: list[int]) -> Column:
    """Lower edge of the bin a length falls into."""
    out = F.lit(0)
    for e in sorted(edges):
        out = F.when(n >= e, e).otherwise(out)
    return out


def length_profile(docs: DataFrame, edges: list[int], by: str = "source") -> DataFrame:
    """Documents and token share per length bin, with the group's median and 90th percentile length."""
    binned = docs.groupBy(by, length_bin(F.col("n_tokens"), edges).alias("bin")).agg(
        F.count("*").alias("n_docs"), F.sum("n_tokens").alias("tokens")
    )
    total = binned.groupBy(by).agg(F.sum("tokens").alias("_total"))
    q = quantiles(docs, "n_tokens", {"p50": 0.5, "p90": 0.9}, (by,)).drop("n")
    return (
        binned.join(total, by)
        .join(q, by)
        .withColumn("token_share", F.try_divide(F.col("tokens"), F.col("_total")))
        .drop("_total")
    )


def upsample_long(
    docs: DataFrame, long_from: int, target: float, by: str = "source", seed: int = 0, doc: str = "doc_id"
) -> DataFrame:
    """Add ``copies``: long documents are repeated until they hold about ``target`` of their source's tokens.

    The source's total stays the same: short documents are thinned by the same amount.  A fractional
    multiplier becomes its whole part plus one more copy for a hash-chosen share of the documents.
    """
    is_long = F.col("n_tokens") >= long_from
    sums = docs.groupBy(by).agg(
        F.count("*").alias("_rows"),
        F.sum("n_tokens").alias("_all"),
        F.sum(F.when(is_long, F.col("n_tokens")).otherwise(0)).alias("_long"),
    )
    share = F.col("_long") / F.col("_all")
    raise_it = (F.col("_long") > 0) & (F.col("_long") < F.col("_all")) & (share < target)
    factors = sums.select(
        by,
        "_rows",
        F.when(raise_it, target / share).otherwise(1.0).alias("_up"),
        F.when(raise_it, (1 - target) / (1 - share)).otherwise(1.0).alias("_down"),
    )
    multiplier = F.when(is_long, F.col("_up")).otherwise(F.col("_down"))
    u = F.conv(F.substring(md5_key(seed, doc), 1, 8), 16, 10).cast("double") / 2.0**32
    copies = F.floor(F.col("multiplier")) + (u < F.col("multiplier") - F.floor("multiplier")).cast("long")
    return (
        skew_join(docs, factors, [by], "_rows", [doc])
        .withColumn("multiplier", multiplier)
        .withColumn("copies", copies)
        .drop("_up", "_down", "_rows")
    )


def repeat_copies(docs: DataFrame) -> DataFrame:
    """One row per copy (``copy_no`` from 0); documents with no copies disappear."""
    return docs.where("copies > 0").select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy_no")
    )


def length_mix(
    docs: DataFrame, quotas: DataFrame, edges: list[int], total: float, seed: int = 0, doc: str = "doc_id"
) -> DataFrame:
    """Documents per length bin in hash order up to the bin's quota (bin, share) of ``total`` tokens."""
    binned = docs.withColumn("bin", length_bin(F.col("n_tokens"), edges))
    budgets = quotas.select("bin", (F.col("share") * total).alias("budget"))
    return take_tokens(binned, budgets, "bin", seed, doc)


def source_order(docs: DataFrame, by: str = "source", seed: int = 0, doc: str = "doc_id", digits: int = 4) -> DataFrame:
    """(pos, doc, n_tokens): documents of a source next to each other, in hash order inside."""
    used = docs.where("n_tokens > 0")
    inside = hash_rank(used, [doc], seed, "_in", (by,), digits)
    totals = used.groupBy(by).agg(F.count("*").alias("_t"))
    # Sources follow each other by name; one row per source is summed up in one place.
    before = totals.select(by, (F.sum("_t").over(W.orderBy(by)) - F.col("_t")).alias("_off"))
    return inside.join(F.broadcast(before), by).withColumn("pos", F.col("_off") + F.col("_in")).drop("_off", "_in")


def pack_to_window(
    docs: DataFrame, tokens: DataFrame, window: int = 131_072, by: str = "source", seed: int = 0, doc: str = "doc_id"
) -> DataFrame:
    """Samples of the window length built from neighbouring documents of the same source."""
    placed = spans(source_order(docs.select(doc, by, "n_tokens"), by, seed, doc))
    return materialize_samples(placed, tokens, window, doc)
