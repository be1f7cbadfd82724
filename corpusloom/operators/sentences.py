"""Sentence boundaries learned from raw text, language by language.

Which words ending in a full stop are abbreviations, which words begin sentences, and which pairs stand together
across a full stop is decided by log-likelihood ratios over counts of the corpus (Kiss and Strunk 2006).
Whether a boundary is one depends only on the language and the two words around it, so boundaries are decided once
for every different pair; a text asks only for its words that end in a full stop.

A word is a run of characters other than space, tab, line feed, carriage return and form feed, without quotes and brackets
around it and commas, semicolons and colons after it.  Its type is that in lower case without one final full stop;
numbers are one type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.skew import skew_lookup
from corpusloom.functions.text import col, let
from corpusloom.session import materialize

# A word with the white space around it, and what is cut off its ends.
PIECE = r"[ \t\n\r\f]*[^ \t\n\r\f]+[ \t\n\r\f]*"
BEFORE, AFTER = " \t\n\r\f\"'([{«“„‘", " \t\n\r\f\"')]}»”’,;:"
NUMBER = r"^[0-9]([0-9.,]*[0-9])?\z"
NUMBER_TYPE = "##"
# Least scores of abbreviations, of words that begin sentences, and of pairs; and how sure the full stop of an abbreviation is.
ABBREVIATION, STARTER, COLLOCATION, SURE = 0.3, 30.0, 7.88, 0.99
ABBREV, START, PAIR = "abbreviation", "starter", "pair"


def cores(text: Column | str) -> Column:
    """The words of a text, in order."""
    return F.transform(F.regexp_extract_all(col(text), F.lit(PIECE), F.lit(0)), core)


def core(piece: Column) -> Column:
    return F.rtrim(F.ltrim(piece, F.lit(BEFORE)), F.lit(AFTER))


def has_stop(word: Column) -> Column:
    """Ends in one full stop (not in an ellipsis)."""
    return word.rlike(r"[^.]\.\z")


def type_of(word: Column) -> Column:
    bare = F.lower(F.regexp_replace(word, r"\.\z", ""))
    return F.when(bare.rlike(NUMBER), F.lit(NUMBER_TYPE)).otherwise(bare)


def is_upper(word: Column) -> Column:
    return word.rlike(r"^\p{Lu}")


def is_lower(word: Column) -> Column:
    return word.rlike(r"^\p{Ll}")


def word_pairs(df: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, a, b, n): how often word ``b`` follows word ``a``; empty where ``a`` is the last of its text."""

    def zipped(ws: Column) -> Column:
        after = F.concat(F.slice(ws, 2, F.greatest(F.size(ws) - 1, F.lit(0))), F.array(F.lit("")))
        return F.when(F.size(ws) > 0, F.arrays_zip(ws.alias("a"), after.alias("b")))

    rows = df.select(lang, F.explode(let(cores(text), zipped)).alias("_p")).select(lang, "_p.a", "_p.b")
    return rows.groupBy(lang, "a", "b").agg(F.count("*").alias("n"))


def _xlogy(x: Column, p: Column) -> Column:
    return F.when((x == 0) | (p <= 0), F.lit(0.0)).otherwise(x * F.log(p))


def log_likelihood(a: Column, b: Column, ab: Column, n: Column) -> Column:
    """Dunning's ratio for events a and b of n, together ``ab`` times."""
    p, p1, p2 = b / n, ab / a, F.try_divide(b - ab, n - a)
    p2 = F.coalesce(p2, F.lit(0.0))
    apart = _xlogy(ab, p) + _xlogy(a - ab, 1 - p) + _xlogy(b - ab, p) + _xlogy(n - a - b + ab, 1 - p)
    joint = _xlogy(ab, p1) + _xlogy(a - ab, 1 - p1) + _xlogy(b - ab, p2) + _xlogy(n - a - b + ab, 1 - p2)
    return 2 * (joint - apart)


def abbreviation_score(types: DataFrame) -> Column:
    """Score of a type with ``n_stop`` and ``n_plain`` occurrences among ``_n`` words of which ``_stops`` end in a full stop.

    The ratio of "its full stop is a part of it" to "its full stop is like any other", lowered for long types and for
    occurrences without a full stop, raised for full stops inside.
    """
    p = F.col("_stops") / F.col("_n")
    stop, plain = F.col("n_stop"), F.col("n_plain")
    ratio = 2 * (stop * F.log(SURE / p) + plain * F.log((1 - SURE) / (1 - p)))
    inside = F.length(F.regexp_replace("type", r"[^.]", ""))
    letters = F.length("type") - inside
    return ratio * F.exp(-letters) * (inside + 1) * F.pow(letters.cast("double"), -plain)


def train(df: DataFrame, lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The model, (lang, kind, a, b, score) for abbreviations, words that begin sentences (``a``) and pairs that stand
    together; and (lang, a, b, breaks): for every pair of words met across a full stop, whether a sentence ends there.

    Tables are as large as the vocabulary and its pairs.  Null texts and languages have no words.
    """
    pairs = df.where(F.col(lang).isNotNull())
    pairs = materialize(word_pairs(pairs, lang, text).withColumns({"t": type_of(F.col("a")), "stop": has_stop(F.col("a"))}), "word-pairs")
    types = pairs.groupBy(lang, F.col("t").alias("type")).agg(
        F.sum(F.when(F.col("stop"), F.col("n")).otherwise(0)).alias("n_stop"), F.sum(F.when(F.col("stop"), 0).otherwise(F.col("n"))).alias("n_plain")
    )
    types = materialize(types, "word-types")
    whole = types.groupBy(lang).agg(F.sum(F.col("n_stop") + F.col("n_plain")).alias("_n"), F.sum("n_stop").alias("_stops"))
    whole = F.broadcast(whole)  # one row per language
    scored = types.join(whole, lang).where((F.col("n_stop") > 0) & F.col("type").rlike(r"\p{L}") & (F.col("_stops") < F.col("_n")))
    abbreviations = scored.withColumn("score", abbreviation_score(scored)).where(F.col("score") >= ABBREVIATION)
    abbreviations = materialize(abbreviations.select(lang, "type", "score"), "abbreviations")

    met = pairs.where(F.col("stop") & (F.col("b") != "")).select(lang, "a", "b", "n", "t", type_of(F.col("b")).alias("u"))
    marked = skew_lookup(met, abbreviations.select(lang, F.col("type").alias("t"), F.lit(True).alias("abbr")), [lang, "t"], ["a", "b"])
    initial = F.col("t").rlike(r"^\p{L}\z")
    sort = F.when(initial, "initial").when(F.col("abbr"), "abbreviation").when(F.col("t") == NUMBER_TYPE, "number").otherwise("plain")
    marked = materialize(marked.withColumn("sort", sort).drop("abbr"), "stops")

    totals = types.select(lang, "type", (F.col("n_stop") + F.col("n_plain")).alias("_b"))
    ends = F.broadcast(marked.where("sort = 'plain'").groupBy(lang).agg(F.sum("n").alias("_a")))
    first = marked.where("sort = 'plain'").groupBy(lang, F.col("u").alias("type")).agg(F.sum("n").alias("_ab"))
    first = first.join(totals, [lang, "type"]).join(ends, lang).join(whole, lang)
    score = log_likelihood(*(F.col(c).cast("double") for c in ("_a", "_b", "_ab", "_n")))
    together = F.col("_ab") / F.col("_b") > F.col("_a") / F.col("_n")
    starters = first.withColumn("score", score).where((F.col("score") >= STARTER) & together)
    starters = materialize(starters.select(lang, "type", "score"), "starters")

    both = marked.where("sort <> 'plain'").groupBy(lang, "t", "u").agg(F.sum("n").alias("_ab")).where(F.col("_ab") > 1)
    both = skew_lookup(both, totals.select(lang, F.col("type").alias("t"), F.col("_b").alias("_a")), [lang, "t"], ["u"])
    both = skew_lookup(both, totals.select(lang, F.col("type").alias("u"), "_b"), [lang, "u"], ["t"]).join(whole, lang)
    both = both.join(starters.select(lang, F.col("type").alias("u")), [lang, "u"], "left_anti")
    likely = F.col("_ab") / F.col("_b") > F.col("_a") / F.col("_n")
    collocations = both.withColumn("score", score).where((F.col("score") >= COLLOCATION) & likely)
    collocations = materialize(collocations.select(lang, "t", "u", "score"), "collocations")

    shape = pairs.where(F.col("b") != "").groupBy(lang, type_of(F.col("b")).alias("u")).agg(
        F.max(is_lower(F.col("b"))).alias("_low"), F.max(is_upper(F.col("b")) & ~F.col("a").rlike(r"[.!?]\z")).alias("_up_inside")
    )
    asked = marked.join(collocations.select(lang, "t", "u", F.lit(True).alias("_pair")), [lang, "t", "u"], "left")
    asked = skew_lookup(asked, shape, [lang, "u"], ["a", "b"])
    asked = skew_lookup(asked, starters.select(lang, F.col("type").alias("u"), F.lit(True).alias("_start")), [lang, "u"], ["a", "b"])
    upper, low, inside = is_upper(F.col("b")), F.coalesce("_low", F.lit(False)), F.coalesce("_up_inside", F.lit(False))
    begins = upper & low & ~inside
    breaks = (
        F.when(F.col("sort") == "plain", F.lit(True))
        .when(F.coalesce("_pair", F.lit(False)), F.lit(False))
        .when(F.col("sort") == "abbreviation", begins | (upper & F.coalesce("_start", F.lit(False))))
        .when(F.col("sort") == "initial", begins)
        .otherwise(~is_lower(F.col("b")))
    )
    decisions = asked.select(lang, "a", "b", breaks.alias("breaks"))
    null = F.lit(None).cast("string")
    model = (
        abbreviations.select(lang, F.lit(ABBREV).alias("kind"), F.col("type").alias("a"), null.alias("b"), "score")
        .unionByName(starters.select(lang, F.lit(START).alias("kind"), F.col("type").alias("a"), null.alias("b"), "score"))
        .unionByName(collocations.select(lang, F.lit(PAIR).alias("kind"), F.col("t").alias("a"), F.col("u").alias("b"), "score"))
    )
    return model, decisions


def split(df: DataFrame, decisions: DataFrame, doc: str = "doc_id", lang: str = "lang", text: str = "text") -> DataFrame:
    """(doc, sentences): arrays of sentences that concatenate back to the text.

    A sentence ends after ``!`` and ``?``, after an ellipsis before a word in upper case, and after a full stop unless
    ``decisions`` say no; a pair of words they do not know, or a language, ends one.  White space goes with the
    word before it.  Null texts have null, texts without words no sentences.  ``doc`` must be unique; other columns are dropped.
    """

    def candidates(ws: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(ws) - 2)
        stops = F.filter(at, lambda i: has_stop(F.get(ws, i)))
        found = F.transform(stops, lambda i: F.struct(i.alias("at"), F.get(ws, i).alias("a"), F.get(ws, i + 1).alias("b")))
        return F.when(F.size(ws) > 1, found)

    asked = df.select(doc, lang, F.explode(let(cores(text), candidates)).alias("_c")).select(doc, lang, "_c.at", "_c.a", "_c.b")
    held = decisions.where("not breaks").select(lang, "a", "b", F.lit(True).alias("_no"))
    none = skew_lookup(asked, held, [lang, "a", "b"], [doc, "at"]).where("_no").groupBy(doc).agg(F.collect_set("at").alias("_open"))
    rows = df.select(doc, text).join(none, doc, "left")
    hold = F.coalesce("_open", F.array().cast("array<int>"))

    def cut(ps: Column) -> Column:
        def ends(i: Column) -> Column:
            w, b = core(F.get(ps, i)), core(F.get(ps, i + 1))
            # Most words are out at a glance; nothing is cut off them.
            return F.get(ps, i).rlike(r"[.!?]") & (w.rlike(r"[!?]\z") | (w.rlike(r"\.\.\z") & is_upper(b)) | has_stop(w))

        last = F.size(ps) - 1
        inner = F.when(last > 0, F.filter(F.sequence(F.lit(0), last - 1), ends)).otherwise(F.array().cast("array<int>"))
        return let(
            F.concat(F.array(F.lit(-1)), F.array_except(inner, hold), F.array(last)),
            lambda e: F.transform(F.sequence(F.lit(1), F.size(e) - 1), lambda k: F.array_join(F.slice(ps, F.get(e, k - 1) + 2, F.get(e, k) - F.get(e, k - 1)), "")),
        )

    parts = F.regexp_extract_all(F.col(text), F.lit(PIECE), F.lit(0))
    sentences = let(parts, lambda ps: F.when(F.size(ps) > 0, cut(ps)).when(ps.isNotNull(), F.array().cast("array<string>")))
    return rows.select(doc, sentences.alias("sentences"))
