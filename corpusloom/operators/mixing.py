"""Mixture weights: temperature, capped uniform, the rule cascade, replay, phases, regression search.

Tables here have one row per language or dataset unless a docstring says otherwise.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.ordering import md5_key, prefix_sum

# Epochs up to which repeated data is worth as much as new data, half, or harms.
FULL_VALUE, HALF_VALUE, HARMFUL = 4, 16, 44

# Bucket suffixes.
HEAD, MIDDLE, TAIL = "head-25", "middle-50", "tail-25"

# Share of the budget per component (low, high).
COMPOSITION = {
    "new_language": (0.60, 0.70),
    "english": (0.15, 0.20),
    "math": (0.03, 0.05),
    "code": (0.03, 0.05),
    "parallel": (0.01, 0.03),
}

# Replay share by kind of shift (low, high).
REPLAY_BANDS = {"same_domain": (0.01, 0.05), "new_domain": (0.05, 0.10), "new_language": (0.20, 0.30)}


def _share(value: Column, total_of: DataFrame, *group: str) -> DataFrame:
    """``total_of`` with ``_share``: value / sum of value over the group (or the whole table)."""
    rows = total_of.withColumn("_x", value.cast("double"))
    if group:
        joined = rows.join(rows.groupBy(*group).agg(F.sum("_x").alias("_sum")), list(group))
    else:
        joined = rows.withColumn("_sum", rows.agg(F.sum("_x")).scalar())
    return joined.withColumn("_share", F.try_divide("_x", "_sum")).drop("_x", "_sum")


def temperature(sizes: DataFrame, alpha: float = 0.3, amount: str = "tokens") -> DataFrame:
    """Add ``weight`` = n^alpha / sum n^alpha."""
    return _share(F.pow(amount, F.lit(alpha)), sizes).withColumnRenamed("_share", "weight")


def unimax(sizes: DataFrame, budget: float, epochs: float = 3, key: str = "lang", amount: str = "tokens") -> DataFrame:
    """Even allocation with at most ``epochs`` passes over any language.

    In order of size a language is capped if its cap fits the even share of what is left; all others
    get the share of the first language that is not capped.  What no language can take stays
    unallocated and shows in ``unallocated``.
    """
    # Windows over one row per language.
    order = W.orderBy(amount, key)
    cap = F.lit(float(epochs)) * F.col(amount)
    rows = sizes.withColumns({"_cap": cap, "_rank": F.row_number().over(order)})
    before = F.sum("_cap").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_cap")
    count = F.count("*").over(W.partitionBy())
    rows = rows.withColumn("_fair", (F.lit(float(budget)) - before) / (count - F.col("_rank") + 1))
    capped = F.col("_cap") <= F.col("_fair")
    level = F.min(F.when(~capped, F.struct("_rank", "_fair"))).over(W.partitionBy())["_fair"]
    given = F.when(capped, F.col("_cap")).otherwise(level)
    out = rows.withColumns({"capped": capped, "allocation": given})
    out = out.withColumns(
        {
            "epochs": F.col("allocation") / F.col(amount),
            "weight": F.col("allocation") / F.sum("allocation").over(W.partitionBy()),
            "unallocated": F.greatest(F.lit(float(budget)) - F.sum("allocation").over(W.partitionBy()), F.lit(0.0)),
        }
    )
    return out.drop("_cap", "_rank", "_fair")


def epoch_report(weights: DataFrame, budget: float, cap: float = FULL_VALUE, amount: str = "tokens") -> DataFrame:
    """Passes over each dataset at this budget, cap breaches, and what the repetition is worth."""
    e = F.col("epochs")
    value = (
        F.when(e <= 1, "unique")
        .when(e <= FULL_VALUE, "full")
        .when(e <= HALF_VALUE, "diminishing")
        .when(e < HARMFUL, "half")
        .otherwise("harmful")
    )
    return weights.withColumn("epochs", F.col("weight") * budget / F.col(amount)).withColumns(
        {"over_cap": e > cap, "value": value}
    )


# ---- cascade -----------------------------------------------------------------------------------
def language_shares(ratios: DataFrame) -> DataFrame:
    """Step 1: (lang, share) from (lang, ratio); zeros are dropped."""
    return _share(F.col("ratio"), ratios).where("_share > 0").select("lang", F.col("_share").alias("share"))


def quality_shares(langs: DataFrame, catalog: DataFrame, cc_ratio: DataFrame) -> DataFrame:
    """Step 2: (lang, quality, share): the override where one is given, else the natural split."""
    is_cc = F.col("quality") == "CC"
    natural = catalog.groupBy("lang").agg(
        F.try_divide(F.sum(F.when(is_cc, F.col("tokens")).otherwise(0)), F.sum("tokens")).alias("_natural")
    )
    cc = F.coalesce("cc_ratio", "_natural", F.lit(0.0))
    both = langs.join(cc_ratio, "lang", "left").join(natural, "lang", "left").withColumn("_cc", cc)
    return both.select(
        "lang",
        F.explode(
            F.array(
                F.struct(F.lit("CC").alias("quality"), (F.col("share") * F.col("_cc")).alias("share")),
                F.struct(F.lit("nonCC").alias("quality"), (F.col("share") * (1 - F.col("_cc"))).alias("share")),
            )
        ).alias("_q"),
    ).select("lang", "_q.*")


def collapse_triplets(catalog: DataFrame) -> DataFrame:
    """Step 3a: (lang, quality, prefix, tokens, head, middle, tail): tagged buckets become one dataset."""
    pattern = rf"^(.*)-({HEAD}|{MIDDLE}|{TAIL})$"
    bucket = F.regexp_extract("dataset", pattern, 2)
    prefix = F.when(bucket != "", F.regexp_extract("dataset", pattern, 1)).otherwise(F.col("dataset"))
    tagged = catalog.withColumns({"prefix": prefix, "_bucket": bucket})
    in_bucket = lambda b: F.sum(F.when(F.col("_bucket") == b, F.col("tokens")))
    return tagged.groupBy("lang", "quality", "prefix").agg(
        F.sum("tokens").alias("tokens"),
        in_bucket(HEAD).alias("head"),
        in_bucket(MIDDLE).alias("middle"),
        in_bucket(TAIL).alias("tail"),
    )


def dataset_shares(pairs: DataFrame, logical: DataFrame) -> DataFrame:
    """Step 3b: equal shares among CC datasets, shares by size among the others."""
    amount = F.when(F.col("quality") == "CC", F.lit(1.0)).otherwise(F.col("tokens").cast("double"))
    within = _share(amount, logical, "lang", "quality")
    return within.join(pairs, ["lang", "quality"]).withColumn("weight", F.col("share") * F.col("_share")).drop(
        "share", "_share"
    )


def tail_to_head(weighted: DataFrame) -> DataFrame:
    """Step 4: (lang, quality, dataset, tokens, weight): triplets expanded, weight moved from tail to head.

    The move is a share ``delta`` of the head's weight; the middle and the total stay as they are.  A
    prefix without head data keeps its natural split.
    """
    h, m, t = (F.coalesce(F.col(c), F.lit(0)).cast("double") for c in ("head", "middle", "tail"))
    part = lambda x: F.try_divide(x, h + m + t) * F.col("weight")
    over = F.try_divide(t, h)
    delta = F.when(h == 0, 0.0).when(t > h, F.least(over - 1, F.lit(1.0))).otherwise(0.5 * over)
    move = part(h) * delta
    bucket = lambda name, x, w: F.when(
        F.col(x).isNotNull(),
        F.struct(F.concat_ws("-", "prefix", F.lit(name)).alias("dataset"), F.col(x).alias("tokens"), w.alias("weight")),
    )
    whole = F.struct(F.col("prefix").alias("dataset"), F.col("tokens"), F.col("weight"))
    split = F.filter(
        F.array(bucket(HEAD, "head", part(h) + move), bucket(MIDDLE, "middle", part(m)), bucket(TAIL, "tail", part(t) - move)),
        lambda x: x.isNotNull(),
    )
    tagged = F.coalesce("head", "middle", "tail").isNotNull()
    return weighted.select("lang", "quality", F.explode(F.when(tagged, split).otherwise(F.array(whole))).alias("_d")).select(
        "lang", "quality", "_d.*"
    )


def cascade(catalog: DataFrame, ratios: DataFrame, cc_ratio: DataFrame) -> DataFrame:
    """Steps 1 to 4: weights of all datasets."""
    pairs = quality_shares(language_shares(ratios), catalog, cc_ratio)
    return tail_to_head(dataset_shares(pairs, collapse_triplets(catalog)))


def check_sum(weights: DataFrame, tolerance: float = 1e-8) -> DataFrame:
    """Step 5: zero weights dropped; every row carries the total and whether it is one."""
    live = weights.where("weight > 0")
    total = live.agg(F.sum("weight")).scalar()
    return live.withColumn("total", total).withColumn("sums_to_one", F.abs(F.col("total") - 1) <= tolerance)


# ---- replay, phases, composition ---------------------------------------------------------------
def take_tokens(
    docs: DataFrame, budgets: DataFrame, group: str, seed: int = 0, doc: str = "doc_id", digits: int = 4
) -> DataFrame:
    """Documents in hash order until the group's token budget is reached (the last one may pass it).

    ``budgets`` is (group, budget), one row per group the caller lists.  The running sums are two-level, so a group may be of any size.
    """
    keyed = docs.withColumn("_h", md5_key(seed, doc)).withColumn("_b", F.substring("_h", 1, digits))
    summed = prefix_sum(keyed, "_b", ["_h", doc], F.col("n_tokens").cast("long"), "tokens_before", (group,))
    return summed.drop("_h", "_b").join(F.broadcast(budgets), group).where(F.col("tokens_before") < F.col("budget")).drop("budget")


def replay_mix(
    new: DataFrame, replay: DataFrame, ratio: float, parts: DataFrame, kind: str = "kind", seed: int = 0, doc: str = "doc_id"
) -> DataFrame:
    """New documents plus a uniform sample of old ones that makes up ``ratio`` of all tokens.

    ``parts`` (kind, part) splits the replay into text, math, code and parallel data.
    """
    amount = new.agg(F.sum("n_tokens") * ratio / (1 - ratio)).scalar()
    budgets = parts.select(kind, (F.col("part") * amount).alias("budget"))
    old = take_tokens(replay, budgets, kind, seed, doc).drop("tokens_before")
    return new.withColumn("origin", F.lit("new")).unionByName(old.withColumn("origin", F.lit("replay")))


def phase_mix(
    docs: DataFrame, budget: float, split: float = 0.85, scarce_below: float = 2e9, alpha: float = 0.3, top: str = "in_top"
) -> DataFrame:
    """(phase, lang, tokens, weight, budget): two phases over documents (lang, n_tokens, in_top).

    Phase 1 uses all documents of languages with enough data; phase 2 the best documents of every
    language, and all documents of the scarce languages, which appear only there.
    """
    size = docs.groupBy("lang").agg(
        F.sum("n_tokens").alias("_all"), F.sum(F.when(F.col(top), F.col("n_tokens")).otherwise(0)).alias("_top")
    )
    scarce = F.col("_all") < scarce_below
    one = size.where(~scarce).select(F.lit(1).alias("phase"), "lang", F.col("_all").alias("tokens"))
    two = size.select(F.lit(2).alias("phase"), "lang", F.when(scarce, F.col("_all")).otherwise(F.col("_top")).alias("tokens"))
    both = one.unionByName(two).where("tokens > 0")
    share = F.when(F.col("phase") == 1, split).otherwise(1 - split) * budget
    return _share(F.pow("tokens", F.lit(alpha)), both, "phase").withColumnRenamed("_share", "weight").withColumn(
        "budget", F.col("weight") * share
    )


def replay_check(ratio: Column | float, shift: Column | str) -> Column:
    """below / ok / above: a replay share against the band of the kind of shift (null for an unknown kind)."""
    r, s = (x if isinstance(x, Column) else F.lit(x) for x in (ratio, shift))
    out = F.lit(None).cast("string")
    for kind, (low, high) in REPLAY_BANDS.items():
        out = F.when(s == kind, F.when(r < low, "below").when(r > high, "above").otherwise("ok")).otherwise(out)
    return out


def composition_check(mix: DataFrame, bands: DataFrame) -> DataFrame:
    """Share of each component (component, tokens) against its band (component, low, high)."""
    shares = _share(F.col("tokens"), mix.groupBy("component").agg(F.sum("tokens").alias("tokens")))
    s = F.coalesce("share", F.lit(0.0))
    status = F.when(s < F.col("low"), "below").when(s > F.col("high"), "above").otherwise("ok")
    return bands.join(shares.withColumnRenamed("_share", "share"), "component", "left").select(
        "component", F.coalesce("tokens", F.lit(0)).alias("tokens"), s.alias("share"), "low", "high", status.alias("status")
    )


# ---- regression search -------------------------------------------------------------------------
def dirichlet(spark: SparkSession, n: int, concentration: list[float], seed: int = 1, parts: int | None = None) -> DataFrame:
    """(mix_id, mix): ``n`` random mixtures; each row's draw depends only on the seed and its id."""
    a = list(concentration)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def draw(ids: pd.Series) -> pd.Series:
        rows = [np.random.default_rng([seed, int(i)]).dirichlet(a) for i in ids]
        return pd.Series([r.tolist() for r in rows])

    ids = spark.range(0, n, 1, parts) if parts else spark.range(n)
    return ids.select(F.col("id").alias("mix_id"), draw("id").alias("mix"))


def fit_losses(proxies: DataFrame, reg: float = 1e-3):
    """Ridge regression of the proxy loss on the mixture: (mix array, loss)."""
    rows = proxies.select(array_to_vector("mix").alias("features"), F.col("loss").alias("label"))
    return LinearRegression(elasticNetParam=0.0, regParam=reg, standardization=False).fit(rows)


def regmix(proxies: DataFrame, candidates: DataFrame, top: int = 10, reg: float = 1e-3) -> DataFrame:
    """The ``top`` candidate mixtures with the lowest predicted loss."""
    model = fit_losses(proxies, reg)
    weights = F.array(*[F.lit(float(c)) for c in model.coefficients])
    predicted = F.aggregate(
        F.zip_with("mix", weights, lambda m, c: m * c), F.lit(float(model.intercept)), lambda acc, x: acc + x
    )
    return candidates.withColumn("predicted_loss", predicted).orderBy("predicted_loss", "mix_id").limit(top)
