"""Phrases of a table of any size found in texts: one automaton a task, or a join where the table is too large for it."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.skew import skew_lookup
from corpusloom.functions.text import col, hold, words
from corpusloom.session import materialize

# Characters of all phrases up to which the table travels to the tasks; an automaton takes some fifty bytes for each.
MAX_CHARS = 4_000_000
# Slots for each phrase in the filter that goes before the join, and slots at most (one bit each).
SLOTS, MAX_SLOTS = 16, 1 << 27


def term_words(text: Column | str) -> Column:
    """Lower-case words without leading and trailing non-letters; what has no letter is no word."""
    bare = F.transform(words(F.lower(col(text))), lambda w: F.regexp_replace(w, r"^[^\p{L}]+|[^\p{L}]+$", ""))
    return F.filter(bare, lambda w: w != "")


def _scanner(phrases: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = ahocorasick.Automaton()
        for p in phrases:
            machine.add_word(f" {p} ", p)
        machine.make_automaton()
        for batch in batches:
            found = []
            for plain in batch.column("plain").to_pylist():
                seen: dict[str, int] = {}
                # Neighbouring phrases share the space between them, so overlaps are found as well.
                for _, p in machine.iter(f" {plain} ") if plain and phrases else ():
                    seen[p] = seen.get(p, 0) + 1
                found.append([{"term": p, "n": n} for p, n in sorted(seen.items())])
            kind = pa.list_(pa.struct([("term", pa.string()), ("n", pa.int64())]))
            rest = [batch.column(k) for k, name in enumerate(batch.schema.names) if name != "plain"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(found, kind)], names=["doc", "terms"])

    return run


def _slots(h: np.ndarray, n: int) -> list[np.ndarray]:
    """The two slots of each hash among ``n``, a power of two."""
    h = h.view(np.uint64)
    return [(x & np.uint64(n - 1)).astype(np.int64) for x in (h, h >> np.uint64(32))]


def _marker(n: int):
    """Rows (word, bits): 64 slots each, those marked that the hashes of a batch have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slot = np.unique(np.concatenate(_slots(b.column("h").to_numpy(), n)))
            word, first = np.unique(slot >> 6, return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (slot & 63).astype(np.uint64), first) if len(slot) else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bits.view(np.int64))], names=["word", "bits"])

    return run


def maybe_listed(phrases: DataFrame, term: str = "term", most: int = MAX_SLOTS):
    """Column function: hash of a word sequence -> false only if no phrase has that hash.

    A Bloom filter of two slots a phrase, at most ``most`` bits (16 MB) whatever the table; where the table is too large
    for them, more sequences pass, and the join decides.
    """
    n = 1 << min(max(SLOTS * phrases.count(), 64).bit_length(), most.bit_length() - 1)
    words_of = phrases.select(F.xxhash64(term).alias("h")).mapInArrow(_marker(n), "word long, bits long")
    marked = words_of.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(n // 64, np.uint64)
    table[marked.column("word").to_numpy()] = marked.column("bits").to_numpy().view(np.uint64)
    shared = phrases.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf(T.BooleanType())
    def maybe(h: pa.Array) -> pa.Array:
        bits, hit = shared.value, np.ones(len(h), bool)
        for slot in _slots(h.to_numpy(), n):
            hit &= ((bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
        return pa.array(hit)

    # Not pushed down to where every row still carries all the words of its text.
    return maybe.asNondeterministic()


def find_terms(
    df: DataFrame, terms: DataFrame, text: str = "text", doc: str = "doc_id", term: str = "term", max_chars: int = MAX_CHARS
) -> DataFrame:
    """(``doc``, term, n): how often each phrase of ``terms`` stands in each text, on whole words.

    Phrases and texts are compared by their words (``term_words``), so case, punctuation and white space do not
    matter.  Every occurrence counts, also those that overlap or lie inside a longer phrase.  Rows that repeat a
    phrase or a ``doc`` count together; phrases without a word, null texts and empty tables find nothing.
    The table is measured: up to ``max_chars`` each task builds one automaton and reads every text once, whatever the
    number of phrases; beyond it the word sequences of the texts, as long as the phrases are, pass a filter of bounded
    size, and those that may be listed are joined to the table.
    """
    phrases = terms.select(term_words(term).alias("_w")).where(F.size("_w") > 0)
    phrases = phrases.select(F.array_join("_w", " ").alias("term"), F.size("_w").alias("len")).distinct()
    chars = phrases.agg(F.sum(F.length("term") + 2)).first()[0] or 0
    if chars <= max_chars:
        listed = [r.term for r in phrases.select("term").collect()]
        pairs = df.select(F.col(doc).alias("doc"), F.col(text).alias("_t"))
        plain = hold(pairs, "plain", F.array_join(term_words("_t"), " ")).drop("_t")
        kind = plain.schema["doc"].dataType.simpleString()
        rows = plain.mapInArrow(_scanner(listed), f"doc {kind}, terms array<struct<term string, n bigint>>")
        found = rows.select("doc", F.inline("terms"))
    else:
        phrases = materialize(phrases, "phrases")
        maybe = maybe_listed(phrases)
        lengths = [r.len for r in phrases.select("len").distinct().collect()]
        held = hold(df.select(F.col(doc).alias("doc"), F.col(text).alias("_t")), "_w", term_words("_t")).drop("_t")
        grams = [
            held.where(F.size("_w") >= k)
            .select("doc", F.explode(F.sequence(F.lit(1), F.size("_w") - (k - 1))).alias("_at"), "_w")
            .select("doc", F.array_join(F.slice("_w", F.col("_at"), k), " ").alias("term"))
            for k in lengths
        ]
        every = grams[0]
        for g in grams[1:]:
            every = every.unionByName(g)
        # Counted per text before anything meets, so a frequent phrase is one row a text.
        counted = every.where(maybe(F.xxhash64("term"))).groupBy("doc", "term").agg(F.count(F.lit(1)).alias("n"))
        found = skew_lookup(counted, phrases.select("term", F.lit(True).alias("listed")), ["term"], ["doc"]).where("listed")
    return found.groupBy("doc", "term").agg(F.sum("n").alias("n")).select(F.col("doc").alias(doc), "term", "n")
