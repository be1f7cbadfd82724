"""Heuristic filters.  Every rule yields its measured value next to its flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.ordering import quantiles
from corpusloom.functions.text import (
    col,
    hold,
    join_lines,
    let,
    lines,
    ratio,
    share_of,
    top_count,
    visible_chars,
    word_count,
    word_ngrams,
    words,
)

# Boilerplate phrases.
BOILERPLATE = ("click here", "terms and conditions", "cookie policy")

# Short stopword lists per language.
STOPWORDS = {
    "en": "the of and to in a is that for it was on with as be by this are at from".split(),
    "fr": "de la le et les des en un du une que pour qui dans au par sur pas plus avec".split(),
    "de": "der die und in den von zu das sich mit auf des dem ein eine ist im nicht als auch".split(),
    "es": "de la que el en y los se del las por un para con no una su al es lo".split(),
}

PHONE_LINE = r"(?:\+\d{1,3}[ .-]?)?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}\b"


def mean_word_length(text: Column | str) -> Column:
    return ratio(visible_chars(text), word_count(text))


def ellipsis_word_share(text: Column | str) -> Column:
    return share_of(words(text), lambda w: w.endswith("..."))


def gopher(
    df: DataFrame,
    min_words: int = 50,
    max_words: int = 100_000,
    min_mean: float = 3,
    max_mean: float = 10,
    max_ellipsis: float = 0.3,
    text: str = "text",
) -> DataFrame:
    """Word count, mean word length and share of words ending in '...', with one flag per rule."""
    # The words are cut once; held, so that a later filter on a flag does not cut them again.
    stats = let(
        words(text),
        lambda ws: F.struct(
            F.size(ws).alias("n"),
            F.aggregate(ws, F.lit(0), lambda acc, w: acc + F.length(w)).alias("chars"),
            F.size(F.filter(ws, lambda w: w.endswith("..."))).alias("dots"),
        ),
    )
    n, mean, dots = F.col("n_words"), F.col("mean_word_len"), F.col("ellipsis_words")
    s = F.col("_stats")
    valued = (
        hold(df, "_stats", stats)
        .withColumns(
            {
                "n_words": s["n"],
                "mean_word_len": ratio(s["chars"], s["n"]),
                "ellipsis_words": ratio(s["dots"], s["n"]),
            }
        )
        .drop("_stats")
    )
    return valued.withColumns(
        {
            "ok_count": n.between(min_words, max_words),
            "ok_mean": mean.between(min_mean, max_mean),
            "ok_ellipsis": dots <= max_ellipsis,
            "passes": n.between(min_words, max_words) & mean.between(min_mean, max_mean) & (dots <= max_ellipsis),
        }
    )


def length_flags(text: Column | str, min_words=100, max_words=100_000, min_chars=1, max_chars=1_000_000) -> dict:
    n, c = word_count(text), F.length(col(text))
    return {
        "n_words": n,
        "n_chars": c,
        "ok_length": n.between(min_words, max_words) & c.between(min_chars, max_chars),
    }


def mean_word_flags(text: Column | str, low: float = 3, high: float = 10) -> dict:
    mean = mean_word_length(text)
    return {"mean_word_len": mean, "ok_mean": mean.between(low, high)}


def symbol_flags(text: Column | str, limit: float = 0.1) -> dict:
    r = ratio(F.regexp_count(col(text), F.lit(r"[#|{}]")), word_count(text))
    return {"symbol_ratio": r, "ok_symbols": r <= limit}


def bullet_flags(text: Column | str, limit: float = 0.9) -> dict:
    r = share_of(lines(text), lambda x: x.rlike(r"^[ \t]*(?:[-*\x{2022}\x{2023}\x{25CF}]|\d+[.)])[ \t]"))
    return {"bullet_ratio": r, "ok_bullets": r <= limit}


def short_line_flags(text: Column | str, max_len: int = 30, limit: float = 0.67) -> dict:
    r = share_of(lines(text), lambda x: F.length(F.trim(x)) < max_len)
    return {"short_line_ratio": r, "ok_short_lines": r <= limit}


def ellipsis_line_flags(text: Column | str, limit: float = 0.3) -> dict:
    r = share_of(lines(text), lambda x: x.rlike(r"(?:\.\.\.|\x{2026})[ \t]*$"))
    return {"ellipsis_ratio": r, "ok_ellipsis_lines": r <= limit}


def _in_list(listed: list[str]):
    return lambda w: w.isin(*listed)


def stopword_flags(text: Column | str, lang: Column | str, lists: dict = STOPWORDS, floor: float = 0.05) -> dict:
    """Share of words found in the stopword list of the row's language (lists are small literals)."""
    clean = F.transform(words(F.lower(col(text))), lambda w: F.regexp_replace(w, r"^[^\p{L}]+|[^\p{L}]+$", ""))
    share = F.lit(None).cast("double")
    for code, stop in lists.items():
        share = F.when(col(lang) == code, share_of(clean, _in_list(stop))).otherwise(share)
    return {"stopword_share": share, "ok_stopwords": share >= floor}


def boilerplate_flags(text: Column | str, phrases: tuple[str, ...] = BOILERPLATE, limit: int = 0) -> dict:
    n = F.regexp_count(F.lower(col(text)), F.lit("|".join(phrases)))
    return {"n_boilerplate": n, "ok_boilerplate": n <= limit}


def repetition_flags(text: Column | str, n: int = 3, max_dup: float = 0.3, max_top: float = 0.2) -> dict:
    """Share of repeated word n-grams inside the document, and share of the most frequent one."""
    grams = word_ngrams(words(text), n)
    dup = let(grams, lambda g: ratio(F.size(g) - F.size(F.array_distinct(g)), F.size(g)))
    top = let(grams, lambda g: ratio(top_count(g), F.size(g)))
    return {
        "dup_ngram_share": dup,
        "top_ngram_share": top,
        "ok_repetition": (dup <= max_dup) & (top <= max_top),
    }


def c4_lines(df: DataFrame, text: str = "text") -> DataFrame:
    """Line rules: keep lines that end in terminal punctuation, mention no javascript, hold no phone number."""
    all_lines = F.col("_lines")
    punct = lambda x: x.rlike(r'[.!?"][ \t]*$')
    script = lambda x: F.lower(x).contains("javascript")
    phone = lambda x: x.rlike(PHONE_LINE)
    kept = F.filter(all_lines, lambda x: punct(x) & ~script(x) & ~phone(x))
    return (
        df.withColumn("_lines", lines(text))
        .withColumns(
            {
                "n_lines": F.size(all_lines),
                "n_no_punct": F.size(F.filter(all_lines, lambda x: ~punct(x))),
                "n_javascript": F.size(F.filter(all_lines, script)),
                "n_phone": F.size(F.filter(all_lines, phone)),
                "n_kept": F.size(kept),
                text: join_lines(kept),
            }
        )
        .drop("_lines")
    )


def iqr_thresholds(df: DataFrame, metric: str, by: str = "lang", k: float = 1.5) -> DataFrame:
    """Per-language quartiles, the fences around them and the 80th percentile, all exact."""
    q = quantiles(df, metric, {"q1": 0.25, "q3": 0.75, "p80": 0.8}, (by,))
    spread = F.col("q3") - F.col("q1")
    return q.withColumns({"low": F.col("q1") - k * spread, "high": F.col("q3") + k * spread})


def apply_thresholds(df: DataFrame, cuts: DataFrame, metric: str, by: str = "lang") -> DataFrame:
    """Flag rows outside the fences of their language (one row per language joins back)."""
    return df.join(F.broadcast(cuts.select(by, "low", "high")), by).withColumn(
        "in_range", F.col(metric).between(F.col("low"), F.col("high"))
    )


def filter_report(df: DataFrame, rules: dict[str, Column], by: list[str], chars: str = "n_chars") -> DataFrame:
    """Per rule and (rolled-up) group: rows that fail, fail only this rule, and characters lost.

    A rule that is null for a row, such as one for another language, does not apply and does not fail.
    One partial aggregate over wide flags; the rules are unpivoted after the groups are small.
    """
    names = list(rules)
    flagged = df.select(*by, chars, *[F.coalesce(~c, F.lit(False)).cast("int").alias(f"_{n}") for n, c in rules.items()])
    fails = sum((F.col(f"_{n}") for n in names), F.lit(0))
    aggs = [F.count("*").alias("n_rows"), F.sum((fails == 0).cast("int")).alias("n_kept")]
    for n in names:
        bad = F.col(f"_{n}")
        aggs += [
            F.sum(bad).alias(f"{n}_failed"),
            F.sum(F.when((bad == 1) & (fails == 1), 1).otherwise(0)).alias(f"{n}_only"),
            F.sum(F.when(bad == 1, F.col(chars)).otherwise(0)).alias(f"{n}_chars"),
        ]
    wide = flagged.rollup(*by).agg(*aggs)
    stacked = F.stack(
        F.lit(len(names)),
        *[x for n in names for x in (F.lit(n), F.col(f"{n}_failed"), F.col(f"{n}_only"), F.col(f"{n}_chars"))],
    ).alias("rule", "n_failed", "n_failed_only", "chars_lost")
    return wide.select(*by, "n_rows", "n_kept", stacked)
