"""From token tables to fixed-length samples.

Documents are laid end to end in a seeded order; sample j covers elements j * L .. j * L + L, one
element of overlap with the next.  Because the layout is an arithmetic rule, every step is a prefix
sum, an integer division or a hash rank, never a walk over the data.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.ordering import md5_key, prefix_sum, range_rank
from corpusloom.functions.text import let
from corpusloom.operators.tokens import EOD
from corpusloom.session import durable_dir

SPLIT_NAMES = ("train", "valid", "test")
# Fixed value: below this share of a full epoch the last epoch is shuffled on its own.
FINAL_EPOCH_SHARE = 0.80


def split_docs(docs: DataFrame, ratios: str = "9999,8,2", doc: str = "doc_id", parts: int | None = None) -> DataFrame:
    """Add ``position`` (dense, in id order) and ``split`` by cumulative document ratio."""
    shares = [float(x) for x in ratios.split(",")]
    shares += [0.0] * (len(SPLIT_NAMES) - len(shares))
    placed = range_rank(docs, [F.col(doc)], "position", parts=parts)
    total = docs.agg(F.count("*")).scalar()
    name, edge = F.lit(SPLIT_NAMES[-1]), sum(shares)
    for i in range(len(SPLIT_NAMES) - 2, -1, -1):
        edge -= shares[i + 1]
        bound = F.round(F.lit(edge / sum(shares)) * F.col("_n"))
        name = F.when(F.col("position") < bound, SPLIT_NAMES[i]).otherwise(name)
    return placed.withColumn("_n", total).withColumn("split", name).drop("_n")


def epochs_needed(tokens_per_epoch: int, n_samples: int, seq_len: int) -> tuple[int, bool]:
    """Epochs for ``n_samples`` (+1 element), and whether the last epoch is shuffled separately."""
    wanted = n_samples * seq_len + 1
    epochs = max(1, -(-wanted // tokens_per_epoch))
    if epochs == 1:
        return 1, False
    before = ((epochs - 1) * tokens_per_epoch - 1) // seq_len
    per_epoch = (tokens_per_epoch - 1) // seq_len
    return epochs, (n_samples - before) < int(FINAL_EPOCH_SHARE * per_epoch)


def document_order(
    docs: DataFrame, epochs: int = 1, seed: int = 1234, separate_final: bool = False, doc: str = "doc_id", digits: int = 4
) -> DataFrame:
    """(pos, epoch, doc, n_tokens): documents of all epochs in one seeded order.

    Documents without tokens are left out.  With ``separate_final`` the last epoch follows the others.
    """
    tiled = docs.where("n_tokens > 0").select(doc, "n_tokens", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    last = F.when(F.col("epoch") == epochs - 1, "1").otherwise("0") if separate_final else F.lit("0")
    keyed = tiled.withColumn("_h", F.concat(last, md5_key(seed, "epoch", doc)))
    keyed = keyed.withColumn("_b", F.substring("_h", 1, digits + 1))
    return prefix_sum(keyed, "_b", ["_h", doc], F.lit(1).cast("long"), "pos").drop("_h", "_b")


def spans(order: DataFrame, width: int = 1_000_000) -> DataFrame:
    """Add ``start`` (elements before the document) to the ordered documents."""
    blocks = order.withColumn("_bucket", F.floor(F.col("pos") / width))
    return prefix_sum(blocks, "_bucket", ["pos"], F.col("n_tokens").cast("long"), "start").drop("_bucket")


def _with_samples(placed: DataFrame, seq_len: int) -> DataFrame:
    return placed.withColumn("n_samples", placed.agg(F.floor((F.sum("n_tokens") - 1) / seq_len)).scalar())


def sample_index(placed: DataFrame, seq_len: int) -> DataFrame:
    """(sample_id, doc_pos, offset): where each sample starts, and a last row where the data ends.

    Every document emits the boundaries that fall into it, so no range join is needed.
    """
    first = F.ceil(F.col("start") / seq_len)
    last = F.least(F.floor((F.col("start") + F.col("n_tokens") - 1) / seq_len), F.col("n_samples"))
    return (
        _with_samples(placed, seq_len)
        .where(first <= last)
        .select(F.explode(F.sequence(first, last)).alias("sample_id"), F.col("pos").alias("doc_pos"), "start")
        .select("sample_id", "doc_pos", (F.col("sample_id") * seq_len - F.col("start")).alias("offset"))
    )


def shuffle_index(samples: DataFrame, seed: int = 1234, digits: int = 4) -> DataFrame:
    """(pos, sample_id): a seeded permutation of the samples."""
    keyed = samples.select("sample_id").withColumn("_h", md5_key(seed, "sample_id"))
    keyed = keyed.withColumn("_b", F.substring("_h", 1, digits))
    return prefix_sum(keyed, "_b", ["_h", "sample_id"], F.lit(1).cast("long"), "pos").select("pos", "sample_id")


def _touched(placed: DataFrame, seq_len: int) -> DataFrame:
    """One row per (document, sample that holds some of its elements), with the element range."""
    start, end = F.col("start"), F.col("start") + F.col("n_tokens")
    first = F.when(start > 0, F.floor((start - 1) / seq_len)).otherwise(F.lit(0).cast("long"))
    last = F.least(F.floor((end - 1) / seq_len), F.col("n_samples") - 1)
    rows = _with_samples(placed, seq_len).where(first <= last).withColumn(
        "sample_id", F.explode(F.sequence(first, last))
    )
    lo = F.greatest(F.col("sample_id") * seq_len, start)
    hi = F.least(F.col("sample_id") * seq_len + seq_len + 1, end)
    return rows.withColumns({"_lo": lo - start, "_len": hi - lo}).where("_len > 0").drop("n_samples")


def materialize_samples(placed: DataFrame, tokens: DataFrame, seq_len: int, doc: str = "doc_id") -> DataFrame:
    """(sample_id, tokens, inputs, labels): ``seq_len`` + 1 tokens; labels are inputs shifted by one.

    The layout is computed on narrow rows and the token arrays join last.  Slices meet per sample; a
    sample never holds more than ``seq_len`` + 1 of them, because empty documents were left out.
    """
    slices = (
        _touched(placed.select(doc, "pos", "start", "n_tokens"), seq_len)
        .join(tokens.select(doc, "tokens"), doc)
        .select("sample_id", "pos", F.slice("tokens", (F.col("_lo") + 1).cast("int"), F.col("_len").cast("int")).alias("t"))
    )
    joined = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("pos", "t"))), lambda x: x["t"]))
    samples = slices.groupBy("sample_id").agg(joined.alias("tokens"))
    return samples.select(
        "sample_id",
        "tokens",
        F.slice("tokens", 1, seq_len).alias("inputs"),
        F.slice("tokens", 2, seq_len).alias("labels"),
    )


def loss_mask(inputs: Column | str, eod_mask_loss: bool = True, eod: int = EOD) -> Column:
    """1 where the loss counts, 0 on end-of-document tokens."""
    x = F.col(inputs) if isinstance(inputs, str) else inputs
    return F.transform(x, lambda t: (t != eod).cast("int") if eod_mask_loss else F.lit(1))


def cu_seqlens(inputs: Column | str, eod: int = EOD) -> Column:
    """Boundaries of the documents inside a sample: 0, the position after each end of document, length."""
    x = F.col(inputs) if isinstance(inputs, str) else inputs
    after = F.filter(F.transform(x, lambda t, i: F.when(t == eod, i + 1)), lambda i: i.isNotNull())
    return F.array_distinct(F.concat(F.array(F.lit(0)), after, F.array(F.size(x))))


def segment_lengths(bounds: Column) -> Column:
    return let(
        bounds,
        lambda b: F.zip_with(
            F.slice(b, F.lit(1), F.size(b) - 1), F.slice(b, F.lit(2), F.size(b) - 1), lambda lo, hi: hi - lo
        ),
    )


def max_seqlen(bounds: Column) -> Column:
    return F.array_max(segment_lengths(bounds))


def position_ids(inputs: Column | str, reset: bool = True, eod: int = EOD) -> Column:
    """0, 1, 2, ... restarting after each end of document when ``reset``."""
    x = F.col(inputs) if isinstance(inputs, str) else inputs
    if not reset:
        return F.sequence(F.lit(0), F.size(x) - 1)
    return F.flatten(F.transform(segment_lengths(cu_seqlens(x, eod)), lambda n: F.sequence(F.lit(0), n - 1)))


def segment_ids(inputs: Column | str, eod: int = EOD) -> Column:
    """Number of the document each token belongs to; i may attend to j iff j <= i and the ids are equal."""
    return F.flatten(
        F.transform(segment_lengths(cu_seqlens(inputs, eod)), lambda n, k: F.array_repeat(k, n))
    )


# Part of every cache key; to be raised when the layout of samples changes.
LAYOUT = 2


def content_key(tokens: DataFrame, doc: str = "doc_id") -> str:
    """A checksum of (doc, tokens) whatever the order of the rows: ids decide the order, so they count."""
    row = F.xxhash64(doc, "tokens")
    return str(tuple(tokens.agg(F.count("*"), F.sum(row.cast("decimal(38,0)")), F.bit_xor(row)).first()))


def cached(spark: SparkSession, config: dict, build) -> DataFrame:
    """The table for this configuration: read if an earlier run committed it, else built and written.

    A run writes to a folder of its own and commits by a one-row table that names it, so a folder that was
    left half written is never read.
    """
    key = hashlib.md5(json.dumps([LAYOUT, config], sort_keys=True).encode()).hexdigest()
    mark = f"{durable_dir(spark)}/cache/{key}"
    try:
        done = spark.read.schema("path string").parquet(mark).select("path").first()
    except AnalysisException:
        done = None
    if done is None:
        path = f"{mark}-{uuid.uuid4().hex}"
        build().write.parquet(path)
        spark.createDataFrame([(path,)], "path string").coalesce(1).write.mode("overwrite").parquet(mark)
        return spark.read.parquet(path)
    return spark.read.parquet(done[0])


def pack_stats(placed: DataFrame, seq_len: int) -> DataFrame:
    """Per number of documents in a sample: how many samples, and the elements lost at the tail."""
    docs = _touched(placed.select("pos", "start", "n_tokens"), seq_len).groupBy("sample_id").agg(
        F.count("*").alias("docs_per_sample")
    )
    total = F.sum("n_tokens")
    tail = placed.agg(total - F.floor((total - 1) / seq_len) * seq_len - 1).scalar()
    return (
        docs.groupBy("docs_per_sample")
        .agg(F.count("*").alias("n_samples"))
        .withColumn("tail_tokens", tail)
    )
