"""Exact, near, line-level and semantic deduplication.

Hot groups are the rule here (one text copied into a third of the corpus), so groups are only ever
reduced with partial aggregates, joined back with salted joins, or cut into bounded blocks.  No
operator lists all pairs of a group.
"""

from __future__ import annotations

import hashlib
import random
from functools import reduce
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.skew import TARGET_ROWS, skew_join
from corpusloom.functions.text import char_ngrams, col, hold, join_lines, let, lines, md5_long, ratio, word_ngrams, words
from corpusloom.session import materialize, small_batches

MERSENNE_31 = (1 << 31) - 1


# ---- exact -------------------------------------------------------------------------------------
def text_key(text: Column | str) -> Column:
    """md5 of the lower-cased text with white space collapsed."""
    return F.md5(F.trim(F.regexp_replace(F.lower(col(text)), r"[ \t\r\n\f]+", " ")))


def exact_keepers(df: DataFrame, doc: str = "doc_id", text: str = "text", *carry: str) -> DataFrame:
    """(text_key, doc, n_copies, carry...): the lowest id of every distinct text, via partial aggregates."""
    keyed = df.select(text_key(text).alias("text_key"), doc, *carry)
    if not carry:  # a plain minimum aggregates by hash, a struct by sort
        return keyed.groupBy("text_key").agg(F.min(doc).alias(doc), F.count("*").alias("n_copies"))
    kept = keyed.groupBy("text_key").agg(F.min(F.struct(doc, *carry)).alias("_k"), F.count("*").alias("n_copies"))
    return kept.select("text_key", "n_copies", "_k.*")


def exact_copies(df: DataFrame, doc: str = "doc_id", text: str = "text", target: int = TARGET_ROWS) -> DataFrame:
    """Ids of the rows whose text is a copy of a row with a lower id."""
    keyed = df.select(text_key(text).alias("text_key"), F.col(doc).alias("_id"))
    first = exact_keepers(df, doc, text).where("n_copies > 1").withColumnRenamed(doc, "_first")
    return skew_join(keyed, first, ["text_key"], "n_copies", ["_id"], target).where("_id > _first").select(F.col("_id").alias(doc))


def exact_dedup(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows whose text is not a copy of a row with a lower id; the few copies are taken out by id."""
    return df.join(exact_copies(df, doc, text), doc, "left_anti")


# ---- shingles and signatures -------------------------------------------------------------------
def shingles(text: Column | str, n: int = 5, unit: str = "word", distinct: bool = True) -> Column:
    """n-grams of words or characters; a shorter text is one shingle, an empty one none."""
    low = F.lower(col(text))
    none = F.array().cast("array<string>")
    if unit == "char":
        grams = let(
            F.regexp_replace(low, r"[ \t\r\n\f]+", " "),
            lambda t: F.when(F.length(t) == 0, none)
            .when(F.length(t) < n, F.array(t))
            .otherwise(char_ngrams(t, (n,))),
        )
    else:
        grams = let(
            words(low),
            lambda ws: F.when(F.size(ws) == 0, none)
            .when(F.size(ws) < n, F.array(F.array_join(ws, " ")))
            .otherwise(word_ngrams(ws, n)),
        )
    return F.array_distinct(grams) if distinct else grams


HASHES = {"md5": md5_long, "xxhash64": lambda c: F.xxhash64(c).bitwiseAND(F.lit((1 << 60) - 1))}


def shingle_sets(
    df: DataFrame, n: int = 5, unit: str = "word", hashing: str = "xxhash64", doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc, shingles): 60-bit shingle hashes.  md5 agrees with other engines, xxhash64 needs no Python."""
    if (unit, hashing) == ("word", "md5"):
        small_batches(df.sparkSession)
        return df.select(doc, _word_hashes(n)(F.lower(col(text)).cast("binary")).alias("shingles"))
    h = F.transform(shingles(text, n, unit, distinct=False), HASHES[hashing])
    return df.select(doc, F.array_distinct(h).alias("shingles"))


def _word_hashes(n: int):
    """``md5_long`` of the word n-grams that ``shingles`` cuts from a lower-cased text, each once, as a function of its bytes.

    A gram is hashed as a slice of the words joined once.  ``str.split`` knows the white space of ``words``.
    """

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def hashes(batch: pa.Array) -> pa.Array:
        found, sizes = [np.empty(0, np.int64)], [0]
        for value in batch:
            ws = [w.encode() for w in (value.as_py() or b"").decode("utf-8", "replace").split()]
            joined = b" ".join(ws)
            starts = [0, *accumulate(len(w) + 1 for w in ws)]
            ends = starts[min(n, len(ws)) :] if ws else []
            digests = b"".join([hashlib.md5(joined[a : b - 1]).digest() for a, b in zip(starts, ends)])
            h = (np.frombuffer(digests, ">u8")[::2] >> 4).astype(np.int64)
            _, first = np.unique(h, return_index=True)
            found.append(h[np.sort(first)])
            sizes.append(len(first))
        ends32 = np.cumsum(sizes).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends32), pa.array(np.concatenate(found)))

    return hashes.asNondeterministic()  # filters on the result are not evaluated in front of it once more


def permutations(k: int, seed: int = 1) -> list[tuple[int, int]]:
    """(a, b) of the k hash permutations x -> (a * x + b) mod (2^31 - 1)."""
    rng = random.Random(seed)
    return [(rng.randrange(1, MERSENNE_31), rng.randrange(MERSENNE_31)) for _ in range(k)]


def minhash(sets: DataFrame, k: int = 128, seed: int = 1, shingles_at_once: int = 1 << 16) -> DataFrame:
    """Add ``signature``: per permutation the minimum over the document's shingles (null if none).

    Row-local: all shingles of a batch go through one vectorised pass per permutation.
    """
    ab = permutations(k, seed)
    mersenne = np.uint64(MERSENNE_31)

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def sign(batch: pa.Array) -> pa.Array:
        offsets = batch.offsets.to_numpy()
        flat = batch.values.to_numpy(zero_copy_only=False)
        sizes = np.diff(offsets)
        filled = np.flatnonzero(sizes)
        out = np.empty((len(filled), k), dtype=np.int64)
        # Rows are taken in slices so that a batch of long documents stays small in memory.
        ends = np.cumsum(sizes[filled])
        i = 0
        while i < len(filled):
            done = ends[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(ends, done + shingles_at_once, side="right")))
            first, last = offsets[filled[i]], offsets[filled[j - 1] + 1]
            h = (flat[first:last] % MERSENNE_31).astype(np.uint64)
            starts = offsets[filled[i:j]] - first
            y, t = np.empty_like(h), np.empty_like(h)
            for p, (a, b) in enumerate(ab):
                # (h * a + b) % mersenne: 2^31 is 1, so the high bits are added to the low ones.
                np.add(np.multiply(h, np.uint64(a), out=y), np.uint64(b), out=y)
                np.right_shift(y, np.uint64(31), out=t)
                np.add(np.bitwise_and(y, mersenne, out=y), t, out=y)
                # Below twice the modulus now; what is below it becomes huge by the subtraction.
                np.minimum(y, np.subtract(y, mersenne, out=t), out=y)
                out[i:j, p] = np.minimum.reduceat(y, starts)
            i = j
        lengths = np.where(sizes > 0, k, 0)
        ends32 = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        return pa.ListArray.from_arrays(
            pa.array(ends32), pa.array(out.reshape(-1)), mask=pa.array(sizes == 0)
        )

    held = hold(sets, "shingles", F.col("shingles"))
    return held.withColumn("signature", sign.asNondeterministic()("shingles"))


def lsh_members(signed: DataFrame, bands: int = 32, rows: int = 4, doc: str = "doc_id") -> DataFrame:
    """(bucket, doc): one row per band; documents that agree on all rows of a band share a bucket."""

    def key(sig: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(bands - 1)),
            lambda i: F.md5(F.concat_ws(",", i.cast("string"), F.array_join(F.slice(sig, i * rows + 1, rows), ","))),
        )

    return signed.where(F.col("signature").isNotNull()).select(
        F.explode(key(F.col("signature"))).alias("bucket"), doc
    )


def _hubs(members: DataFrame, doc: str) -> DataFrame:
    return (
        members.groupBy("bucket").agg(F.min(doc).alias("hub"), F.count("*").alias("_n")).where(F.col("_n") > 1)
    )


def lsh_candidates(members: DataFrame, doc: str = "doc_id", target: int = TARGET_ROWS) -> DataFrame:
    """(doc, hub): every bucket member with the lowest id of its bucket - linear in the members."""
    star = skew_join(members, _hubs(members, doc), ["bucket"], "_n", [doc], target)
    return star.where(F.col(doc) != F.col("hub")).select(doc, "hub").distinct()


def verify_jaccard(
    pairs: DataFrame, sets: DataFrame, doc: str = "doc_id", other: str = "hub", target: int = TARGET_ROWS
) -> DataFrame:
    """Add the exact Jaccard similarity of the two shingle sets of each pair."""
    left = sets.select(F.col("doc_id").alias(doc), F.col("shingles").alias("_a"))
    load = pairs.groupBy(other).agg(F.count("*").alias("_n"))
    right = load.join(sets.select(F.col("doc_id").alias(other), F.col("shingles").alias("_b")), other)
    # A hub may be in very many pairs: its set is repeated per part rather than sent to one task.
    both = skew_join(pairs, right, [other], "_n", [doc], target).join(left, doc)
    common = F.size(F.array_intersect("_a", "_b"))
    return both.select(
        *pairs.columns, ratio(common, F.size("_a") + F.size("_b") - common).alias("jaccard")
    )


def _forest(nodes: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, tau: float) -> list[tuple]:
    """A spanning forest (doc, hub, jaccard) of the pairs of ``left`` and ``right`` members that reach ``tau``."""
    value, at = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    common = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    for lo in range(0, len(value), 4096):  # shared shingles by a product of incidence matrices
        i, j = np.searchsorted(at, [lo, lo + 4096])
        x = np.zeros((len(sets), 4096), np.float32)
        x[owner[i:j], at[i:j] - lo] = 1
        common += x[left] @ x[right].T
    size = np.array([len(x) for x in sets], np.float64)
    score = common / (size[left][:, None] + size[right][None, :] - common)
    near = (score >= tau) & (left[:, None] != right[None, :])
    root = np.arange(len(sets))
    rank = np.argsort(np.argsort(nodes, kind="stable"), kind="stable")
    out = []
    # Breadth first from the lowest id: every member but the first of its tree gives one verified edge.
    for start in np.argsort(rank):
        if root[start] < 0:
            continue
        root[start] = -1
        todo = [int(start)]
        for x in todo:
            for row, col_, table in ((np.flatnonzero(left == x), right, near), (np.flatnonzero(right == x), left, near.T)):
                for r in row:
                    for y in col_[np.flatnonzero(table[r])].tolist():
                        if root[y] >= 0:
                            root[y] = -1
                            todo.append(y)
                            s = score if table is near else score.T
                            out.append((nodes[y], nodes[x], float(s[r, np.flatnonzero(col_ == y)[0]])))
    return out


def near_dup_edges(
    members: DataFrame,
    sets: DataFrame,
    tau: float = 0.8,
    doc: str = "doc_id",
    target: int = TARGET_ROWS,
    block: int = 1024,
    tasks: int | None = None,
) -> DataFrame:
    """(doc, hub, jaccard) edges at or above ``tau`` that connect what any verified pair of a bucket connects.

    ``sets`` (doc_id, shingles) hold every document that shares a bucket.  Documents with equal sets are one
    node.  Buckets with the same content are looked at once; the members of each are cut into blocks of at
    most ``block``, two blocks meet in a task, and every pair of them is compared by one matrix product.  A
    task returns a spanning forest of its near pairs, so results are linear in the members and the number of
    jobs is fixed.  The comparisons inside a bucket are quadratic in its different texts; more rows per band
    make buckets smaller.
    """
    ordered = F.sort_array("shingles")
    nodes = materialize(sets.select("doc_id", F.xxhash64(ordered).alias("_a"), F.hash(ordered).alias("_b"), F.size("shingles").alias("_c")), "lsh-nodes")
    first = nodes.groupBy("_a", "_b", "_c").agg(F.min("doc_id").alias("hub"), F.count("*").alias("_n"))
    equal = skew_join(nodes, first, ["_a", "_b", "_c"], "_n", ["doc_id"], target).select(F.col("doc_id").alias(doc), "hub")
    equal = materialize(equal, "lsh-equal")
    buckets = (
        members.join(equal.select(doc, F.col("hub").alias("_node")), doc)
        .select("bucket", F.col("_node").alias("node"))
        .distinct()
    )
    held = buckets.groupBy("bucket").agg(
        F.count("*").alias("_n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("_sum")
    ).where("_n > 1")
    chosen = held.groupBy("_n", "_sum").agg(F.min("bucket").alias("bucket")).select("bucket", "_n")
    met = skew_join(buckets, chosen, ["bucket"], "_n", ["node"], target)
    spread = met.withColumn("_g", F.ceil(F.col("_n") / F.lit(block)).cast("int")).select(
        "bucket", "node", F.pmod(F.xxhash64("node"), F.col("_g")).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), F.col("_g") - 1)).alias("other")
    )
    rows = spread.select(
        F.concat_ws(":", "bucket", F.least("own", "other"), F.greatest("own", "other")).alias("pair"),
        F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "node",
    ).join(sets.select(F.col("doc_id").alias("node"), "shingles"), "node")
    kind = sets.schema["doc_id"].dataType.simpleString()

    def verify(table: pa.Table) -> pa.Table:
        out = []
        table = table.sort_by([("pair", "ascending"), ("node", "ascending")])
        pair = table.column("pair").to_pylist()
        a, b, own, node = (table.column(c).to_pylist() for c in ("a", "b", "own", "node"))
        lists = table.column("shingles").combine_chunks() if len(table) else None
        at = 0
        while at < len(pair):
            end = at
            while end < len(pair) and pair[end] == pair[at]:
                end += 1
            if end - at > 1:
                found = [lists[k].values.to_numpy(zero_copy_only=False) for k in range(at, end)]
                where = np.array(own[at:end])
                left, right = np.flatnonzero(where == a[at]), np.flatnonzero(where == b[at])
                if len(left) and len(right):
                    out += _forest(np.array(node[at:end]), found, left, right, tau)
            at = end
        cols = list(zip(*out)) or [(), (), ()]
        ids = table.schema.field("node").type
        return pa.table([pa.array([x.item() if hasattr(x, "item") else x for x in cols[0]], ids), pa.array([x.item() if hasattr(x, "item") else x for x in cols[1]], ids), pa.array(cols[2], pa.float64())], names=[doc, "hub", "jaccard"])

    n_tasks = tasks or 4 * int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("_task", F.pmod(F.xxhash64("pair"), F.lit(n_tasks)))
    near = dealt.groupBy("_task").applyInArrow(verify, f"`{doc}` {kind}, hub {kind}, jaccard double")
    same = equal.where(F.col(doc) != F.col("hub")).select(doc, "hub", F.lit(1.0).alias("jaccard"))
    return near.unionByName(same).distinct()


def no_edges(members: DataFrame, doc: str) -> DataFrame:
    """An empty edge table."""
    none = members.where(F.lit(False))
    return none.select(doc, F.col(doc).alias("hub"), F.lit(0.0).alias("jaccard"))


def connected_components(edges: DataFrame, a: str, b: str, target: int = TARGET_ROWS) -> DataFrame:
    """(node, component): the lowest id reachable over the edges, for every node that has an edge.

    Alternating large-star and small-star steps; each is a min aggregate and a salted join, each round
    is written to the shared folder, and rounds go on until nothing changes.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    e = materialize(edges.where(F.col(a) != F.col(b)).select(u, v).distinct(), "cc")
    state = _fingerprint(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("_n"))
        large = (
            skew_join(both, low, ["u"], "_n", ["v"], target)
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = materialize(large, "cc")
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("_n"))
        small = skew_join(large, low, ["u"], "_n", ["v"], target)
        moved = small.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = low.select("u", F.col("m").alias("v"))
        e = materialize(moved.unionByName(own).distinct(), "cc")
        now = _fingerprint(e)
        if now == state:
            break
        state = now
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)


def _fingerprint(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def near_dup_clusters(
    df: DataFrame,
    tau: float = 0.8,
    n: int = 5,
    bands: int = 32,
    rows: int = 4,
    hashing: str = "xxhash64",
    doc: str = "doc_id",
    target: int = TARGET_ROWS,
) -> DataFrame:
    """(doc, cluster): the near-duplicate cluster of every document, named by its lowest id."""
    signed = minhash(shingle_sets(df, n, "word", hashing, doc), bands * rows)
    members = materialize(lsh_members(signed, bands, rows, doc), "lsh-members")
    # Shingles are only stored for documents that share a bucket, not for the whole corpus.
    shared = skew_join(members, _hubs(members, doc), ["bucket"], "_n", [doc], target).select(doc).distinct()
    sets = shingle_sets(df.join(shared, doc, "left_semi"), n, "word", hashing, doc)
    sets = materialize(sets.withColumnRenamed(doc, "doc_id"), "shingles")
    edges = near_dup_edges(members, sets, tau, doc, target)
    found = connected_components(edges, doc, "hub", target)
    return df.select(doc).join(found.withColumnRenamed("node", doc), doc, "left").select(
        doc, F.coalesce("component", F.col(doc)).alias("cluster")
    )


def near_dedup(df: DataFrame, doc: str = "doc_id", **options) -> DataFrame:
    """One document per near-duplicate cluster; the others are taken out by id."""
    clusters = near_dup_clusters(df, doc=doc, **options)
    return df.join(clusters.where(F.col(doc) != F.col("cluster")).select(doc), doc, "left_anti")


# ---- lines -------------------------------------------------------------------------------------
def line_dedup(df: DataFrame, min_len: int = 1, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Every line stays only at its first place in the corpus (lowest id, then position).

    First places come straight out of a partial aggregate, so a line that a third of the documents
    share needs no join on the line; the places go back to their documents by id.
    """
    at = df.select(doc, F.posexplode(lines(text)).alias("_pos", "_line")).where(F.length("_line") >= min_len)
    if isinstance(df.schema[doc].dataType, T.IntegralType):
        # Id and position as one number: its minimum aggregates by hash, that of a struct only by sort.
        place = F.col(doc).cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(11,0)") + F.col("_pos")
        least = at.groupBy(F.md5("_line").alias("_h")).agg(F.min(place).alias("_p"))
        pos = F.pmod("_p", F.lit(1 << 31).cast("decimal(11,0)"))
        first = least.select(
            ((F.col("_p") - pos) / F.lit(1 << 31)).cast(df.schema[doc].dataType).alias(doc), pos.cast("int").alias("_pos")
        )
    else:
        first = at.groupBy(F.md5("_line").alias("_h")).agg(F.min(F.struct(doc, "_pos")).alias("_first")).select("_first.*")
    kept = first.groupBy(doc).agg(F.collect_set("_pos").alias("_keep"))
    joined = df.join(kept, doc, "left").withColumn("_all", lines(text))
    keep = F.coalesce("_keep", F.array().cast("array<int>"))
    places = F.array_sort(
        F.array_union(
            keep,
            F.filter(
                F.transform(
                    F.col("_all"), lambda x, i: F.when(F.length(x) < min_len, i)
                ),
                lambda i: i.isNotNull(),
            ),
        )
    )
    kept_lines = let(places, lambda ps: F.transform(ps, lambda i: F.get(F.col("_all"), i)))
    return joined.withColumns({"n_lines": F.size("_all"), "n_kept": F.size(places), text: join_lines(kept_lines)}).drop(
        "_all", "_keep"
    )


# ---- semantic ----------------------------------------------------------------------------------
def assign_clusters(df: DataFrame, k: int, vec: str = "embedding", out: str = "cluster", seed: int = 7) -> DataFrame:
    """K-means cluster of each embedding; pick k so that a cluster stays around a few blocks."""
    vectors = df.withColumn("_v", array_to_vector(F.transform(vec, lambda x: x.cast("double"))))
    model = KMeans(k=k, seed=seed, featuresCol="_v", predictionCol=out, maxIter=20).fit(vectors)
    return model.transform(vectors).drop("_v")


def semantic_matches(
    df: DataFrame, eps: float, cluster: str, vid: str = "vec_id", vec: str = "embedding", block: int = 2_000
) -> DataFrame:
    """(vid, match): the lowest id in the same cluster with cosine similarity of at least 1 - eps.

    A cluster of n vectors is cut into about n / ``block`` blocks; one task holds two blocks, compares
    them with one matrix product, and returns at most one row per vector.  Exact for any cluster size,
    and no pair leaves the task.
    """
    sizes = df.groupBy(cluster).agg(F.count("*").alias("_n"))
    parts = F.ceil(F.col("_n") / F.lit(block)).cast("int")
    placed = skew_join(df.select(cluster, vid, vec), sizes.withColumn("_g", parts), [cluster], "_n", [vid])
    placed = placed.withColumn("_i", F.pmod(F.xxhash64(F.lit(17), vid), F.col("_g")).cast("int"))
    spread = placed.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_g") - 1))).select(
        cluster,
        vid,
        vec,
        "_i",
        F.least("_i", "_j").alias("_p"),
        F.greatest("_i", "_j").alias("_q"),
    )

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf[vid].to_numpy()
        m = np.stack(pdf[vec].to_numpy()).astype(np.float64)
        m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
        order = np.argsort(ids, kind="stable")
        ids, m = ids[order], m[order]
        own = pdf["_i"].to_numpy()[order]
        p, q = (np.flatnonzero(own == pdf[c].iloc[0]) for c in ("_p", "_q"))
        out_id, out_match = [], []
        # Pairs inside a block are compared once, in the task that holds it alone.
        for rows_of, cols_of in [(p, p)] if pdf["_p"].iloc[0] == pdf["_q"].iloc[0] else [(p, q), (q, p)]:
            for at in range(0, len(rows_of) if len(cols_of) else 0, 512):
                rows = rows_of[at : at + 512]
                close = (m[rows] @ m[cols_of].T) >= 1.0 - eps
                first = ids[cols_of[close.argmax(axis=1)]]
                hit = close.any(axis=1) & (first < ids[rows])
                out_id.append(ids[rows[hit]])
                out_match.append(first[hit])
        if not out_id:
            return pd.DataFrame({vid: ids[:0], "match": ids[:0]})
        return pd.DataFrame({vid: np.concatenate(out_id), "match": np.concatenate(out_match)})

    kind = df.schema[vid].dataType
    result = T.StructType([T.StructField(vid, kind), T.StructField("match", kind)])
    matched = spread.groupBy(cluster, "_p", "_q").applyInPandas(compare, result)
    return matched.groupBy(vid).agg(F.min("match").alias("match"))


def semantic_dedup(df: DataFrame, eps: float, cluster: str, vid: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """Vectors without an earlier neighbour in their cluster."""
    return df.join(semantic_matches(df, eps, cluster, vid, vec), vid, "left_anti")


# ---- report ------------------------------------------------------------------------------------
def dup_report(df: DataFrame, by: tuple[str, str] = ("lang", "source"), doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents before and after exact deduplication per rolled-up group, and the duplicate rate.

    Keepers carry their group out of the aggregate, so there is no join on documents; the two small
    reports are joined null-safe because rolled-up columns are null.
    """
    before = df.rollup(*by).agg(F.count("*").alias("n_before"))
    after = exact_keepers(df, doc, text, *by).rollup(*by).agg(F.count("*").alias("n_after")).select(
        *[F.col(c).alias(f"_{c}") for c in by], "n_after"
    )
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    joined = before.join(after, same, "left").withColumn("n_after", F.coalesce("n_after", F.lit(0)))
    return joined.select(
        *by, "n_before", "n_after", ratio(F.col("n_before") - F.col("n_after"), F.col("n_before")).alias("dup_rate")
    )
