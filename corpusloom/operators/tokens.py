"""Sentence splitting, tokenisation, token counts and verification.

The tokenizer is lossless: a text is cut into pieces (a word with its leading space, or one white
space character); pieces in the vocabulary have one id, others fall back to their UTF-8 bytes.
Ids: 0 end of document, 1..256 bytes, 257.. vocabulary by falling count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.ordering import md5_key, range_rank
from corpusloom.functions.skew import skew_join
from corpusloom.functions.text import chunks, col, hold, let
from corpusloom.session import small_batches

EOD = 0
FIRST_BYTE = 1
FIRST_WORD = 257
PIECE = r" ?[^ \t\n\r\f]+|[ \t\n\r\f]"
# Shortest run that ends in terminal punctuation before white space or the end of the text.
SENTENCE = r"(?s).+?(?:[.!?]+(?:\s+|\z)|\z)"
# Characters per piece before sentence splitting, and per chunk of an over-long text.
MAX_SPLIT_CHARS = 1_000_000
CHUNK_CHARS = 300_000


def split_sentences(text: Column | str, keep_newlines: bool = False, piece: int = MAX_SPLIT_CHARS) -> Column:
    """Sentences of a text; with ``keep_newlines`` they concatenate back to the text."""
    raw = F.flatten(F.transform(chunks(text, piece), lambda t: F.regexp_extract_all(t, F.lit(SENTENCE), F.lit(0))))
    if keep_newlines:
        return raw
    return F.filter(F.transform(raw, lambda s: F.regexp_replace(s, r"^\s+|\s+$", "")), lambda s: s != "")


def pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))


def train_vocab(df: DataFrame, size: int, text: str = "text") -> DataFrame:
    """(token, n, id): the ``size`` most frequent pieces, ids by (count desc, token).

    Counting is one partial aggregate; only the top ``size`` rows reach the numbering window.
    """
    counts = df.select(F.explode(pieces(col(text))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    top = counts.orderBy(F.col("n").desc(), "token").limit(size)
    number = F.row_number().over(W.orderBy(F.col("n").desc(), "token"))
    return top.select("token", "n", (number + (FIRST_WORD - 1)).alias("id"))


def _vocab_list(vocab: DataFrame) -> list[str]:
    """The vocabulary in id order; it has as many entries as its training was asked for."""
    return [r[1] for r in sorted(vocab.select("id", "token").collect())]


def _offsets32(ends: np.ndarray) -> np.ndarray:
    """Arrow offsets; a batch whose values do not fit them is refused, not wrapped."""
    if len(ends) and ends[-1] > np.iinfo(np.int32).max:
        raise OverflowError("an Arrow batch holds more than 2**31 values: lower spark.sql.execution.arrow.maxRecordsPerBatch")
    return ends.astype(np.int32)


def encoder(vocab: DataFrame):
    """Column function: array<array<string>> of pieces per sentence -> array<array<int>> of ids.

    One hash lookup over all pieces of an Arrow batch; no row-by-row Python.
    """
    small_batches(vocab.sparkSession)
    shared = vocab.sparkSession.sparkContext.broadcast(_vocab_list(vocab))
    known_words: list[pa.Array] = []  # built by the first batch of a task

    @F.arrow_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
    def encode(batch: pa.Array) -> pa.Array:
        if not known_words:
            known_words.append(pa.array(shared.value, pa.string()))
        sentences = batch.flatten()
        words = sentences.flatten()
        ids = pc.index_in(words, value_set=known_words[0])
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        width = np.where(known, 1, pc.binary_length(words).to_numpy(zero_copy_only=False)).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(width)])
        out = np.empty(ends[-1], dtype=np.int32)
        out[ends[:-1][known]] = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)[known] + FIRST_WORD
        other = pa.concat_arrays([words.filter(pa.array(~known)).cast(pa.large_binary())])
        data = np.frombuffer(other.buffers()[2] or b"", dtype=np.uint8)
        offsets = np.frombuffer(other.buffers()[1], dtype=np.int64)[: len(other) + 1]
        first, size = ends[:-1][~known], np.diff(offsets)
        at = np.repeat(first - (offsets[:-1] - offsets[0]), size) + np.arange(size.sum())
        out[at] = data[offsets[0] : offsets[0] + size.sum()].astype(np.int32) + FIRST_BYTE
        inner = np.concatenate([[0], np.cumsum(pc.list_value_length(sentences).to_numpy(zero_copy_only=False))])
        outer = np.concatenate([[0], np.cumsum(pc.list_value_length(batch).to_numpy(zero_copy_only=False))])
        per_sentence = pa.ListArray.from_arrays(pa.array(_offsets32(ends[inner])), pa.array(out))
        return pa.ListArray.from_arrays(pa.array(_offsets32(outer)), per_sentence)

    # Expensive: evaluated once, never copied into filters.
    return encode.asNondeterministic()


def decoder(vocab: DataFrame):
    """Column function: array<int> of ids -> text, end-of-document ids skipped."""
    small_batches(vocab.sparkSession)
    shared = vocab.sparkSession.sparkContext.broadcast(_vocab_list(vocab))
    symbols: list[pa.Array] = []  # built by the first batch of a task

    @F.arrow_udf(T.StringType())
    def decode(batch: pa.Array) -> pa.Array:
        if not symbols:
            all_bytes = [b""] + [bytes([i]) for i in range(256)] + [t.encode() for t in shared.value]
            symbols.append(pa.array(all_bytes, pa.large_binary()))
        taken = symbols[0].take(batch.flatten())
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(taken).to_numpy(zero_copy_only=False))])
        rows = np.concatenate([[0], np.cumsum(pc.list_value_length(batch).to_numpy(zero_copy_only=False))])
        # The bytes already lie in order: a document is a longer slice of the same buffer.
        offsets = pa.py_buffer(_offsets32(ends[rows]).tobytes())
        return pa.Array.from_buffers(pa.string(), len(batch), [None, offsets, taken.buffers()[2]])

    return decode.asNondeterministic()


def tokenize(
    df: DataFrame, vocab: DataFrame, append_eod: bool = True, text: str = "text", sentences: bool = False
) -> DataFrame:
    """Add tokens, sentence_lens and n_tokens.

    ``text`` may be a string or an array of sentences; ``sentences`` splits a string first.  Sentences
    without tokens are skipped, the end-of-document id closes the last one, and an empty text has no
    tokens at all.  Null texts are dropped.  Row-local: nothing is shuffled.
    """
    t = F.col(text)
    if isinstance(df.schema[text].dataType, T.ArrayType):
        parts = t
    elif sentences:
        parts = split_sentences(t)
    else:
        parts = F.array(t)
    encode = encoder(vocab)
    cut = hold(df.where(t.isNotNull()), "_pieces", F.transform(parts, pieces))
    encoded = cut.withColumn("_ids", encode("_pieces")).drop("_pieces")
    full = F.filter("_ids", lambda s: F.size(s) > 0)
    flat, lens = F.flatten(F.col("_ids")), F.transform(full, F.size)
    any_token = F.size(full) > 0
    if append_eod:
        flat = F.when(any_token, F.concat(flat, F.array(F.lit(EOD)))).otherwise(flat)
        lens = let(
            lens,
            lambda ls: F.when(
                F.size(ls) > 0,
                F.concat(F.slice(ls, F.lit(1), F.size(ls) - 1), F.array(F.element_at(ls, -1) + 1)),
            ).otherwise(ls),
        )
    return (
        encoded.withColumns({"tokens": flat, "sentence_lens": lens})
        .withColumn("n_tokens", F.size("tokens"))
        .drop("_ids")
    )


def chunk_long(df: DataFrame, size: int = CHUNK_CHARS, text: str = "text") -> DataFrame:
    """Texts above ``size`` characters become several documents (``chunk_no``); blank chunks are dropped."""
    return df.select("*", F.posexplode(chunks(text, size)).alias("chunk_no", "_chunk")).where(
        F.length(F.trim("_chunk")) > 0
    ).withColumn(text, F.col("_chunk")).drop("_chunk")


def count_tokens(tokens: DataFrame, by: list[str]) -> DataFrame:
    """Documents, sequences and tokens per rolled-up group."""
    return tokens.rollup(*by).agg(
        F.count("*").alias("n_docs"),
        F.sum(F.size("sentence_lens")).alias("n_sequences"),
        F.sum("n_tokens").alias("n_tokens"),
    )


# ---- verification ------------------------------------------------------------------------------
def verify_nonempty(tokens: DataFrame, expected: DataFrame, shard: str = "shard") -> DataFrame:
    """Every expected shard with its documents and tokens; missing, empty and unexpected ones are named."""
    found = tokens.groupBy(shard).agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    wanted = expected.select(shard).distinct().withColumn("_want", F.lit(True))
    status = (
        F.when(F.col("_want").isNull(), "unexpected")
        .when(F.coalesce("n_docs", F.lit(0)) == 0, "missing")
        .when(F.coalesce("n_tokens", F.lit(0)) == 0, "empty")
        .otherwise("ok")
    )
    return found.join(wanted, shard, "full_outer").select(
        shard, F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"),
        status.alias("status"),
    )


def verify_counts(raw: DataFrame, tokens: DataFrame, file: str = "file_name", text: str = "text") -> DataFrame:
    """Raw lines against converted documents per file, with the reasons for a gap."""
    corrupt = F.col("_corrupt_record").isNotNull() if "_corrupt_record" in raw.columns else F.lit(False)
    null = F.col(text).isNull() & ~corrupt
    blank = F.col(text).isNotNull() & (F.length(F.trim(text)) == 0)
    lines = raw.groupBy(file).agg(
        F.count("*").alias("n_lines"),
        F.count_if(null).alias("n_null"),
        F.count_if(blank).alias("n_blank"),
        F.count_if(corrupt).alias("n_corrupt"),
    )
    chunked = F.count_if(F.col("chunk_no") > 0) if "chunk_no" in tokens.columns else F.lit(0).cast("long")
    docs = tokens.groupBy(file).agg(F.count("*").alias("n_docs"), chunked.alias("n_chunked"))
    joined = lines.join(docs, file, "full_outer").na.fill(0)
    gap = F.col("n_docs") - F.col("n_lines")
    known = F.col("n_chunked") - F.col("n_null") - F.col("n_blank") - F.col("n_corrupt")
    status = F.when(gap == 0, "ok").when(gap == known, "explained").otherwise("mismatch")
    return joined.withColumns({"gap": gap, "status": status})


def verify_roundtrip(
    raw: DataFrame,
    tokens: DataFrame,
    vocab: DataFrame,
    share: float = 1.0,
    seed: int = 0,
    doc: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Decode a hash-chosen share of the documents and compare the whole text."""
    chosen = F.conv(F.substring(md5_key(seed, doc), 1, 8), 16, 10).cast("double") < share * 2.0**32
    decode = decoder(vocab)
    decoded = tokens.where(chosen).select(doc, decode("tokens").alias("_decoded"))
    return raw.where(chosen).select(doc, text).join(decoded, doc, "left").select(
        doc, F.coalesce(F.col(text) == F.col("_decoded"), F.lit(False)).alias("matches")
    )


def verify_merge_totals(shards: DataFrame, merged: DataFrame, shard: str = "shard") -> DataFrame:
    """Documents and tokens per shard and in total (null shard), with the merged table's totals."""
    per_shard = shards.rollup(shard).agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    total = merged.agg(F.struct(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens"))).scalar()
    same = (F.col("n_docs") == F.col("merged_docs")) & (F.col("n_tokens") == F.col("merged_tokens"))
    both = per_shard.withColumn("_m", total).withColumns({"merged_docs": F.col("_m.docs"), "merged_tokens": F.col("_m.tokens")})
    return both.drop("_m").withColumn("tally", F.when(F.col(shard).isNull(), same))


def verify_merge_index(
    shards: DataFrame, merged: DataFrame, order: Column, shard: str = "shard", local: str = "local_id"
) -> DataFrame:
    """Rows whose merged position does not hold the expected shard row (empty when the merge is right).

    The expected position is the shard's offset plus the local index; every row is checked by an
    equi-join on the position.
    """
    sizes = shards.groupBy(shard).agg(F.count("*").alias("_n"))
    before = W.orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)  # one row per shard
    offsets = sizes.select(shard, "_n", (F.sum("_n").over(before) - F.col("_n")).alias("_off"))
    expected = skew_join(shards, offsets, [shard], "_n", [local]).select(
        (F.col("_off") + F.col(local)).alias("global_id"), F.col(shard), F.col(local), F.col("n_tokens").alias("_want")
    )
    got = merged.select("global_id", F.col("n_tokens").alias("_got"))
    return expected.join(got, "global_id", "full_outer").where(~F.col("_want").eqNullSafe(F.col("_got")))


def doc_offsets(
    tokens: DataFrame, item_bytes: int = 4, doc: str = "doc_id", parts: int | None = None
) -> DataFrame:
    """Element and byte offset of every document in id order (a two-level prefix sum; ids may be sparse)."""
    slim = tokens.select(doc, "n_tokens")
    placed = range_rank(slim, [F.col(doc)], "element_offset", (), F.col("n_tokens").cast("long"), parts)
    return placed.withColumn("byte_offset", F.col("element_offset") * item_bytes)
