"""Spelling variants: words one edit apart, found through words over a reduced alphabet.

Letters are hashed to a few symbols, dealt so that all symbols are about equally frequent in the vocabulary.
Words at most one edit apart have reduced words at most one edit apart, so every word sends out the one-edit
neighbourhood of its reduced word, the neighbourhoods are joined with the reduced vocabulary, and what meets is
verified on the words themselves.  Every pair is generated at one of its ends only: by deletion from the longer
word, by replacement from the word with the lower symbol, by the reduced word itself where both are equal.

Words above ``LONG`` letters, whose neighbourhoods would be as large as the square of their length, meet by the
half that one edit leaves alone: first or last letters, half as many as the shorter word of the pair has.

The corpus is read once, to count words; all later tables are as large as the vocabulary or its neighbour pairs.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import materialize

# Fixed values of the contract: letters, the share of corrupted occurrences, least length and count, and the ratio.
LETTERS = r"A-Za-zÀ-ÿ"
EVERY, MIN_LENGTH, MIN_COUNT, RATIO = 199, 6, 5, 5
SYMBOLS = 8
LONG = 48
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, every: int = EVERY, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of at least ``min_length`` letters and ``min_count`` occurrences in all texts.

    Runs of letters are lower-cased (A-Z only).  Where ``every`` divides the checksum of ``<doc_id>:<run>``, one
    letter is left out, chosen by the checksum.  A null text has no words, a null ``doc_id`` is written as ''.
    """
    run = F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), run.alias("_run"))
    check = F.crc32(F.concat_ws(":", "_id", "_run").cast("binary"))
    at = F.pmod(F.col("_crc"), F.length("_run")).cast("int")
    short = F.concat(F.substring(F.col("_run"), F.lit(1), at), F.substring(F.col("_run"), at + 2, F.length("_run")))
    word = F.when(F.col("_crc") % every == 0, short).otherwise(F.col("_run")).alias("word")
    words = runs.withColumn("_crc", check).select(word).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def alphabet(words: DataFrame, symbols: int = SYMBOLS) -> dict[str, str]:
    """Letter to symbol; the most frequent letters first, each to the symbol with the least load.

    There are at most as many letters as the pattern of a word has, 116.
    """
    letter = F.explode(F.split("word", "")).alias("letter")
    load = [(0, k) for k in range(symbols)]
    deal = {}
    for r in words.select(letter).where("letter <> ''").groupBy("letter").count().orderBy(F.desc("count"), "letter").collect():
        n, k = heapq.heappop(load)
        deal[r["letter"]] = chr(97 + k)
        heapq.heappush(load, (n + r["count"], k))
    return deal


def reduce_word(word: Column | str, deal: dict[str, str]) -> Column:
    """The word over the reduced alphabet."""
    return F.translate(word, "".join(deal), "".join(deal.values()))


def neighbourhood(reduced: Column, symbols: int) -> Column:
    """What the reduced word generates: each word with one symbol left out or replaced by a higher one."""
    place = F.sequence(F.lit(1), F.length(reduced))

    def around(i: Column, middle: Column) -> Column:
        return F.concat(F.substring(reduced, F.lit(1), i - 1), middle, F.substring(reduced, i + 1, F.length(reduced)))

    higher = F.array(*[F.lit(chr(97 + k)) for k in range(symbols)])
    left_out = F.transform(place, lambda i: around(i, F.lit("")))
    replaced = F.flatten(
        F.transform(place, lambda i: F.transform(F.filter(higher, lambda c: c > F.substring(reduced, i, F.lit(1))), lambda c: around(i, c)))
    )
    return F.array_distinct(F.concat(left_out, replaced))


def near_pairs(words: DataFrame, symbols: int = SYMBOLS, long: int = LONG) -> DataFrame:
    """(a, n_a, b, n_b): every unordered pair of words that differ by one inserted, deleted or replaced letter, once.

    ``words`` has one row per ``word`` with its count ``n``.
    """
    short = words.where(F.length("word") <= long + 1)  # a word one letter longer can be near one of ``long`` letters
    deal = alphabet(short, symbols)
    reduced = short.withColumn("_r", reduce_word("word", deal))
    known = reduced.select(F.xxhash64("_r").alias("_key"), F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("_r").alias("_rb"))
    sent = F.explode(F.concat(F.array("_r"), neighbourhood(F.col("_r"), symbols)))
    # The reduced word is the first of what is sent; where it meets itself, the smaller word takes the pair.
    generated = reduced.select(sent.alias("_s"), F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("_r").alias("_ra"))
    generated = generated.select(F.xxhash64("_s").alias("_key"), "a", "n_a", (F.col("_s") == F.col("_ra")).alias("_same"))
    # Spark sizes a table by what it read, before an explode and compressed, so it would broadcast these.
    met = generated.hint("merge").join(known.drop("_rb"), "_key").where(F.col("a") != F.col("b")).where(~F.col("_same") | (F.col("a") < F.col("b")))
    met = met.where((F.length("a") <= long) | (F.length("b") <= long))
    pairs = met.where(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b")

    far = words.where(F.length("word") > long)
    size = F.length("word")
    tags = far.select("word", "n", F.explode(F.array(size, size - 1)).alias("_tag")).where(F.col("_tag") >= long)
    half = F.floor(F.col("_tag") / 2).cast("int")
    ends = F.array(F.substring(F.col("word"), F.lit(1), half), F.substring(F.col("word"), size - half + 1, half))
    halves = tags.select("word", "n", "_tag", F.posexplode(ends).alias("_side", "_end"))
    halves = halves.select("word", "n", F.xxhash64("_tag", "_side", "_end").alias("_key"))
    left = halves.select("_key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = halves.select("_key", F.col("word").alias("b"), F.col("n").alias("n_b"))
    rest = left.hint("merge").join(right, "_key").where(F.col("a") < F.col("b")).where(F.levenshtein("a", "b", 1) == 1)
    return pairs.unionByName(rest.drop("_key").distinct())


def variants(
    docs: DataFrame,
    every: int = EVERY,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    symbols: int = SYMBOLS,
    long: int = LONG,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the vocabulary.

    ``form`` is the near word of largest count (ties: the smallest in code-point order) where that count is at
    least ``ratio`` times the word's own, else null; ``root`` is where the forms of forms end, the word itself
    without a form.  A table without words gives an empty result; rows that repeat count again, extra columns
    are ignored.
    """
    words = materialize(vocabulary(docs, every, min_length, min_count), "vocabulary")
    pairs = materialize(near_pairs(words, symbols, long), "near-words")
    near = pairs.select(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("other"), F.col("n_b").alias("m")).unionAll(
        pairs.select("b", "n_b", "a", "n_a")
    )
    first = F.min(F.struct((-F.col("m")).alias("m"), "other"))
    stats = near.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), first.alias("_top"))
    enough = -F.col("_top.m") >= ratio * F.col("n")
    stats = stats.select(
        "word", "n_near", F.when(enough, F.col("_top.other")).alias("form"), F.when(enough, -F.col("_top.m")).alias("form_n")
    )
    stats = materialize(stats, "forms")
    ends = roots(stats, ratio, min_count).hint("merge")
    return words.join(stats.hint("merge"), "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )


def roots(forms: DataFrame, ratio: int = RATIO, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, root) for words with a form, by pointer doubling.

    Counts grow by ``ratio`` at every step, so the longest chain, and with it the number of rounds, follows from
    the largest count: four rounds reach counts of 10**12.
    """
    links = forms.where("form is not null").select("word", F.col("form").alias("root"))
    top = forms.agg(F.max("form_n")).first()[0] or 0
    steps = max(1, int(math.log(max(top / max(min_count, 1), 1), ratio) + 1e-9)) if ratio > 1 else 64
    for _ in range(math.ceil(math.log2(steps))):
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        links = links.join(onward.hint("merge"), "root", "left").select("word", F.coalesce("_next", "root").alias("root"))
        links = materialize(links, "roots")
    return links
