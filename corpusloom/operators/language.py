"""Character n-gram language profiles and detection."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.ordering import md5_key, quantiles
from corpusloom.functions.skew import skew_lookup
from corpusloom.functions.text import char_ngrams, col, lines, ratio
from corpusloom.session import small_batches

# Probability given to an n-gram a profile does not hold.
UNSEEN = 1e-6


def _clean(text: Column | str) -> Column:
    return F.lower(F.replace(col(text), F.lit("\n"), F.lit(" ")))


def _grams(text: Column | str, sizes: tuple[int, ...]) -> Column:
    return char_ngrams(_clean(text), sizes)


def _count_grams(sizes: tuple[int, ...], chars_at_once: int = 1_000_000):
    """Arrow batches of (lang, text) -> (lang, gram, n), counted once per slice instead of one row per n-gram."""

    def run(batches):
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            first, size = 0, 0
            for i, t in enumerate(texts):
                size += len(t or "")
                if size < chars_at_once and i < len(texts) - 1:
                    continue
                part, names = [t or "" for t in texts[first : i + 1]], langs[first : i + 1]
                codes_of = {x: k for k, x in enumerate(dict.fromkeys(names))}
                owner_lang = np.array([codes_of[x] for x in names])
                chars, owner = _flat(part)
                out: tuple[list, list, list] = ([], [], [])
                for n in sizes:
                    code, row = _codes(chars, owner, n)
                    for name, k in codes_of.items():
                        found, times = np.unique(code[owner_lang[row] == k], return_counts=True)
                        shifts = [21 * (n - 1 - j) for j in range(n)]
                        points = np.stack([(found >> x) & 0x1FFFFF for x in shifts], 1).astype(np.uint32) - 1
                        joined = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
                        out[0].extend([name] * len(found))
                        out[1].extend(joined[j : j + n] for j in range(0, len(joined), n))
                        out[2].extend(times.tolist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], names=["lang", "gram", "n"]
                )
                first, size = i + 1, 0

    return run


def train_lang_profiles(
    df: DataFrame, top_k: int = 300, sizes: tuple[int, ...] = (1, 2, 3), lang: str = "lang", text: str = "text"
) -> DataFrame:
    """(lang, gram, n, p, rank): the ``top_k`` most frequent character n-grams of each language.

    n-grams are counted in Python, slice by slice, so what is shuffled is one row per n-gram and slice; the
    rank filter is applied before the shuffle as well as after it, so no task sees more than ``top_k`` rows per
    language and map task.
    """
    if max(sizes) > 3:
        raise ValueError("n-grams of more than 3 characters do not fit the codes")
    small_batches(df.sparkSession)
    rows = df.select(F.col(lang).alias("lang"), _clean(text).alias("text")).mapInArrow(_count_grams(sizes), "lang string, gram string, n long")
    counts = rows.withColumnRenamed("lang", lang).groupBy(lang, "gram").agg(F.sum("n").alias("n"))
    totals = counts.groupBy(lang).agg(F.sum("n").alias("_total"))
    ranked = counts.withColumn(
        "rank", F.row_number().over(W.partitionBy(lang).orderBy(F.col("n").desc(), F.col("gram")))
    ).where(F.col("rank") <= top_k)
    return ranked.join(totals, lang).select(lang, "gram", "n", (F.col("n") / F.col("_total")).alias("p"), "rank")


def _codes(chars: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of a flat code-point array as numbers, and the row each belongs to; none crosses a row."""
    if len(chars) < n:
        return chars[:0], owner[:0]
    last = len(chars) - n + 1
    code = np.zeros(last, dtype=np.int64)
    for k in range(n):
        # 21 bits per code point; the +1 keeps shorter n-grams apart from longer ones.
        code = (code << 21) | (chars[k : last + k] + 1)
    whole = owner[:last] == owner[n - 1 :]
    return code[whole], owner[:last][whole]


def _flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    return chars, np.repeat(np.arange(len(texts)), [len(t) for t in texts])


def _scorer(profiles: list, langs: list[str], sizes: tuple[int, ...], chars_at_once: int = 1_000_000):
    """Column function: text -> summed weight per language, for (gram, lang, weight) profile rows."""
    grams = sorted({g for g, _, _ in profiles})
    per_gram = [_codes(*_flat([g]), len(g))[0][0] for g in grams]
    order = np.argsort(per_gram)
    known = np.array(per_gram, dtype=np.int64)[order]
    place = {grams[o]: i for i, o in enumerate(order)}
    weight = np.zeros((len(grams), len(langs)))
    for g, lang, w in profiles:
        weight[place[g], langs.index(lang)] = w

    def score(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(langs)))
        chars, owner = _flat(texts)
        for n in sizes:
            code, row = _codes(chars, owner, n)
            at = np.minimum(np.searchsorted(known, code), len(known) - 1)
            hit = known[at] == code
            row, at = row[hit], at[hit]
            for k in range(len(langs)):
                out[:, k] += np.bincount(row, weights=weight[at, k], minlength=len(texts))
        return out

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def scored(text: pd.Series) -> pd.Series:
        texts = text.fillna("").tolist()
        parts, first, size = [], 0, 0
        # Slices of whole rows keep the flat arrays small, whatever the text lengths.
        for i, t in enumerate(texts):
            size += len(t)
            if size >= chars_at_once or i == len(texts) - 1:
                parts.extend(score(texts[first : i + 1]).tolist())
                first, size = i + 1, 0
        return pd.Series(parts)

    return scored.asNondeterministic()


def detect_lang(
    df: DataFrame,
    profiles: DataFrame,
    threshold: float = 0.5,
    ids: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    sizes: tuple[int, ...] = (1, 2, 3),
    joined: bool = False,
) -> DataFrame:
    """(ids, lang_pred, confidence): most likely language, ``unknown`` below the threshold.

    Each language scores the log-likelihood of the text's n-grams; a text that no language scores above
    zero, which is what n-grams unknown to all profiles give, is ``unknown``.  Confidence is the best
    language's share of the likelihood; ties go to the first language name.

    Profiles hold ``top_k`` rows per language, so they travel to the tasks and documents are scored in
    place, without a shuffle.  ``joined`` gives the same by joining n-grams to the profiles, for callers
    whose profiles are too large for a task.
    """
    if max(sizes) > 3:
        raise ValueError("n-grams of more than 3 characters do not fit the codes")
    floor = math.log(UNSEEN)
    weights = profiles.select("gram", "lang", (F.log("p") - floor).alias("w"))
    if joined:
        found = df.select(*ids).join(_joined_scores(df, weights, ids, text, sizes), list(ids), "left")
    else:
        small_batches(df.sparkSession)
        rows = weights.collect()
        langs = sorted({r[1] for r in rows})
        scorer = _scorer([tuple(r) for r in rows], langs, sizes)
        sums = df.select(*ids, scorer(_clean(text)).alias("_s"))
        top = F.array_max("_s")
        share = 1 / F.aggregate("_s", F.lit(0.0), lambda acc, x: acc + F.exp(x - F.array_max("_s")))
        best = F.element_at(F.array(*[F.lit(x) for x in langs]), F.array_position("_s", top).cast("int"))
        found = sums.select(*ids, F.when(top > 0, best).alias("_best"), F.when(top > 0, share).alias("confidence"))
    return found.select(
        *ids,
        F.when(F.col("confidence") >= threshold, F.col("_best")).otherwise("unknown").alias("lang_pred"),
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
    )


def _joined_scores(
    df: DataFrame, weights: DataFrame, ids: tuple[str, ...], text: str, sizes: tuple[int, ...]
) -> DataFrame:
    """(ids, _best, confidence) by joining n-grams to a profile table of any size."""
    n_langs = weights.agg(F.countDistinct("lang").alias("_langs"))
    grams = df.select(*ids, F.explode(_grams(text, sizes)).alias("gram"))
    by_gram = weights.groupBy("gram").agg(F.collect_list(F.struct("lang", "w")).alias("_p"))
    matched = skew_lookup(grams, by_gram, ["gram"], list(ids)).select(*ids, F.explode("_p").alias("_e"))
    scored = matched.groupBy(*ids, F.col("_e.lang").alias("_lang")).agg(F.sum("_e.w").alias("_s"))
    per_doc = scored.groupBy(*ids).agg(F.sort_array(F.collect_list(F.struct("_s", "_lang"))).alias("_all"))
    top = F.element_at("_all", -1)
    best = F.array_min(F.transform(F.filter("_all", lambda x: x["_s"] == top["_s"]), lambda x: x["_lang"]))
    weight = F.aggregate(
        F.col("_all"), F.lit(0.0), lambda acc, x: acc + F.exp(x["_s"] - top["_s"])
    ) + (F.col("_langs") - F.size("_all")) * F.exp(-top["_s"])
    return per_doc.withColumn("_langs", n_langs.scalar()).select(
        *ids,
        F.when(top["_s"] > 0, best).alias("_best"),
        F.when(top["_s"] > 0, F.lit(1.0) / weight).alias("confidence"),
    )


def paragraph_lang(
    df: DataFrame,
    profiles: DataFrame,
    target: Column,
    window: int = 1,
    frac: float = 0.5,
    doc: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Share of paragraphs in the target language, smoothed over ``window`` neighbours on both sides.

    A paragraph counts as target when most of the paragraphs in its window are detected as the target;
    a document is kept when the share of such paragraphs reaches ``frac``.
    """
    paras = df.select(doc, target.alias("_target"), F.posexplode(lines(text)).alias("para_no", "para")).where(
        F.length(F.trim("para")) > 0
    )
    # Paragraph and target go through the scorer with the text, so nothing is joined back.
    labels = detect_lang(paras, profiles, ids=(doc, "para_no", "_target"), text="para")
    hit = (F.col("lang_pred") == F.col("_target")).cast("double")
    near = W.partitionBy(doc).orderBy("para_no").rowsBetween(-window, window)
    smooth = labels.withColumn("_in", (F.avg(hit).over(near) > 0.5).cast("int"))
    share = ratio(F.sum("_in"), F.count("*"))
    return smooth.groupBy(doc).agg(
        F.count("*").alias("n_paragraphs"), share.alias("target_share"), (share >= frac).alias("keep")
    )


def propose_min_confidence(scored: DataFrame, point: float, lang: str = "lang_pred") -> DataFrame:
    """(lang, n, min_confidence): an exact per-language quantile of the detection confidence."""
    return quantiles(scored, "confidence", {"min_confidence": point}, (lang,))


def min_confidence_by_lang(scored: DataFrame, cuts: DataFrame, default: float, lang: str = "lang_pred") -> DataFrame:
    """Route every row to its label or to ``unknown`` by the threshold of its own language (one row each)."""
    limits = cuts.select(lang, F.col("min_confidence").alias("_min"))
    return scored.join(F.broadcast(limits), lang, "left").select(
        "*",
        F.when(F.col("confidence") >= F.coalesce("_min", F.lit(default)), F.col(lang))
        .otherwise("unknown")
        .alias("routed"),
    ).drop("_min")


def lang_noise_audit(df: DataFrame, noise: Column, per_lang: int = 20, seed: int = 0, doc: str = "doc_id") -> DataFrame:
    """Noise share of each language, over all documents and over a hash-ordered sample for review."""
    flagged = df.select(doc, "lang", noise.cast("int").alias("_noise"))
    whole = flagged.groupBy("lang").agg(F.count("*").alias("n_docs"), F.sum("_noise").alias("n_noise"))
    order = W.partitionBy("lang").orderBy("_h", doc)
    sample = (
        flagged.withColumn("_h", md5_key(seed, doc))
        .withColumn("_rn", F.row_number().over(order))
        .where(F.col("_rn") <= per_lang)
        .groupBy("lang")
        .agg(F.count("*").alias("n_sampled"), F.sum("_noise").alias("n_noise_sampled"))
    )
    return whole.join(sample, "lang").withColumn("noise_share", ratio(F.col("n_noise"), F.col("n_docs")))
