"""N-gram Jaccard join over a MinHash LSH forest, with exact verification.

Texts are sets of hashed word shingles.  Each of ``trees`` tries holds every text under a label of ``depth`` MinHash
values; labels are bytes, so their order is the order of the trie and a prefix of a label is a trie node.  Two texts of
similarity t share a prefix of length d in some trie with probability 1 - (1 - t**d)**trees.  Every text starts at
its whole label and shortens it until that probability reaches the target recall for the least similarity that its
links can have, which depends on its number of shingles: a text of three has links of similarity 1 alone and keeps the
whole label, one of seven has none below 6/7 and keeps six values, long ones come down to four.  A link is bounded from
both of its ends, so a pair may meet at the longer prefix of the two; texts below a trie node that reach it are
candidates, and every candidate pair is verified on the exact sets.

Equal texts are one node from the start, so copies cost nothing.  A trie node that holds the same texts as
another one is looked at once, large ones are cut into blocks that are compared two by two, and a
pair that meets in several trie nodes counts in the first.  Tasks return what is linear in their input: the
number of links of each text and a forest of verified links, never a list of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.skew import skew_join
from corpusloom.llm.common import ROLL, materialize, mix, running, slices, text_stats, utf8, window_hash, without, word_hashes
from corpusloom.llm.repeats import joined, parts_of, starts_inside
from corpusloom.operators.dedup import connected_components

WORDS = 5
THRESHOLD = 0.8
TREES, DEPTH = 20, 8
# Bytes that a label keeps of each of its MinHash values; values that agree in them by chance only add candidates.
VALUE = 2
RECALL = 0.9999
# Texts that one task compares with each other.
BLOCK = 1024
NO_ID = -(1 << 63)


def prefix_length(threshold: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix, from ``depth`` down, at which the tries reach ``recall`` at ``threshold``."""
    for d in range(depth, 1, -1):
        if 1 - (1 - threshold**d) ** trees >= recall:
            return d
    return 1


@lru_cache(maxsize=1 << 16)
def least_similarity(size: int, threshold: float) -> float:
    """The lowest similarity, ``threshold`` or more, of a set of ``size`` to any set; 1 if only equal sets reach it."""
    common = np.arange(1, size + 1)
    # A shade below the threshold: rounding may only lower the bound.
    union = np.floor(common / (threshold - 1e-9))
    some = union > size if threshold < 1 else np.zeros(size, bool)
    # With all of the set in common, the other one has at least one more; else the union is the set itself or more.
    some |= (union >= size) & (common < size)
    return float((common[some] / union[some]).min()) if some.any() else 1.0


@lru_cache(maxsize=1 << 16)
def label_length(size: int, threshold: float, trees: int, depth: int, recall: float) -> int:
    """How many values of its labels a text of ``size`` shingles must not be shortened beyond."""
    return prefix_length(least_similarity(size, threshold), trees, depth, recall)


def shingles(raw: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``n``-word windows of all texts and where each text's begin (n + 1 entries).

    A text of fewer than ``n`` words, but at least one, has the one shingle of all its words.
    """
    words, first = word_hashes(raw, offsets)
    run = running(words)
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < n))
    starts = np.r_[starts_inside(first, n), first[short]]
    stops = np.r_[starts[: len(starts) - len(short)] + n, first[short + 1]]
    doc = np.searchsorted(first, starts, "right") - 1
    order = np.argsort(doc, kind="stable")
    return window_hash(run, starts[order], stops[order]), np.searchsorted(doc[order], np.arange(len(first)))


def _signer(n: int, trees: int, depth: int, threshold: float, recall: float):
    multipliers = mix(np.arange(1, trees * depth + 1, dtype=np.uint64) * ROLL) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            values, first = shingles(*utf8(piece.column("text")), n)
            size = np.diff(first)
            some = np.flatnonzero(size)
            labels = np.empty((len(some), trees, depth), ">u2")
            for k in range(trees * depth if len(some) else 0):
                least = np.minimum.reduceat(values * multipliers[k], first[:-1][some])
                labels[:, k // depth, k % depth] = (mix(least) >> np.uint64(48)).astype(np.uint16)
            width = depth * VALUE
            flat = pa.Array.from_buffers(pa.binary(), len(some) * trees, [
                None, pa.py_buffer(np.arange(0, (len(some) * trees + 1) * width, width, dtype=np.int32)), pa.py_buffer(labels.tobytes())
            ])
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.where(size > 0, trees, 0))].astype(np.int32)), flat)
            # Shingles that a text repeats are one member of its set.
            distinct = np.zeros(len(piece), np.int64)
            if len(some):
                owner = np.repeat(np.arange(len(piece)), size)
                order = np.lexsort((values, owner))
                new = np.r_[True, (values[order][1:] != values[order][:-1]) | (owner[order][1:] != owner[order][:-1])]
                distinct = np.bincount(owner[order][new], minlength=len(piece))
            need = pa.array([label_length(int(k), threshold, trees, depth, recall) if k else depth for k in distinct], pa.int32())
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("node"), need, lists], names=["doc_id", "node", "need", "labels"])

    return run


def trie_nodes(texts: DataFrame, depth: int, stop: int) -> tuple[DataFrame, DataFrame]:
    """Trie nodes where texts meet, and the texts of each: (key, n) and (node, doc_id, key).

    ``texts`` are (node, doc_id, need, labels).  A text stands at all nodes of its path from its whole label up to
    ``need`` values; two texts may meet where the one with the longer ``need`` stops, so nodes are kept where some
    text stops and another one stands.  Nodes with the same texts count as one.  Paths are followed only below
    prefixes of ``stop`` values, the shortest there are, that hold two texts or more.
    """
    members = texts.select("node", "doc_id", "need", F.posexplode("labels").alias("tree", "label"))
    prefix = lambda d: F.xxhash64("tree", d, F.substring("label", F.lit(1), d * F.lit(VALUE)))
    members = members.withColumn("root", prefix(F.lit(stop)))
    roots = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.max("need").alias("deepest")).where("n > 1")
    paths = skew_join(members, roots, ["root"], "n", ["node"]).withColumn("d", F.explode(F.sequence("need", "deepest")))
    paths = materialize(paths.select("node", "doc_id", prefix(F.col("d")).alias("key"), (F.col("d") == F.col("need")).alias("stops")), "paths")
    # What a trie node holds: how many texts, and a sum that tells equal contents.
    held = paths.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.max("stops").alias("stops"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum")
    ).where("n > 1 and stops")
    chosen = held.groupBy("n", "sum").agg(F.min("key").alias("key")).select("key", "n")
    return chosen, paths.select("node", "doc_id", "key")


def _zip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for b in batches:
        body = pa.array([pack((t or "").encode()) for t in b.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("node"), body], names=["doc_id", "node", "body"])


def common_counts(sets: list[np.ndarray], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets ``rows`` with sets ``cols``."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    value, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Shingles of one set alone are in no intersection; the rest is numbered anew.
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[at]
    at, owner = number[at[keep]], owner[keep]
    out = np.zeros((len(rows), len(cols)), np.float32)
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    width = 2048
    for lo in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(at, [lo, lo + width])
        x = np.zeros((len(sets), width), np.float32)
        x[owner[a:b], at[a:b] - lo] = 1
        out += x[rows] @ x[cols].T
    return out


def _verifier(n: int, threshold: float):
    schema = "node binary, hub binary, links long"

    def one(bucket: int, a: int, b: int, nodes: list[bytes], blocks: list[int], mine: list[list[int]], bodies: list[bytes]):
        unpack = zstandard.ZstdDecompressor().decompress
        values, first = shingles(*joined([unpack(x) for x in bodies]), n)
        sets = [np.unique(values[s:e]) for s, e in zip(first[:-1], first[1:])]
        size = np.array([len(s) for s in sets], np.float64)
        block = np.array(blocks)
        rows, cols = np.flatnonzero(block == a), np.flatnonzero(block == b)
        common = common_counts(sets, rows, cols).astype(np.float64)
        union = size[rows][:, None] + size[cols][None, :] - common
        near = common / np.maximum(union, 1) >= threshold
        near &= rows[:, None] != cols[None, :]
        # Links that another, earlier trie node has counted.
        before = sorted({x for m in mine for x in m if x < bucket})
        counted = near
        if before:
            number = {x: k for k, x in enumerate(before)}
            y = np.zeros((len(nodes), len(before)), np.float32)
            for k, m in enumerate(mine):
                for x in m:
                    if x < bucket:
                        y[k, number[x]] = 1
            counted = near & ~((y[rows] @ y[cols].T) > 0)
        links = np.zeros(len(nodes), np.int64)
        np.add.at(links, rows, counted.sum(1))
        if a != b:
            np.add.at(links, cols, counted.sum(0))
        # Least text of everything that is linked here, by spreading labels.
        label = np.argsort(np.argsort(np.array(nodes, object)))
        while True:
            new = label.copy()
            if near.size:
                big = len(nodes)
                np.minimum.at(new, rows, np.where(near, label[cols][None, :], big).min(1))
                np.minimum.at(new, cols, np.where(near, new[rows][:, None], big).min(0))
            if (new == label).all():
                break
            label = new
        by_rank = sorted(nodes)
        hit = np.union1d(rows[near.any(1)], cols[near.any(0)]) if near.size else []
        return [(nodes[k], by_rank[label[k]], int(links[k])) for k in hit]

    def run(table: pa.Table) -> pa.Table:
        out: list[tuple] = []
        table = table.sort_by([("bucket", "ascending"), ("a", "ascending"), ("b", "ascending")])
        ids = [table.column(c).to_pylist() for c in ("bucket", "a", "b", "node", "block", "mine")]
        body = table.column("body").combine_chunks() if len(table) else []
        at = 0
        while at < len(table):
            end, seen, pick = at, set(), []
            key = (ids[0][at], ids[1][at], ids[2][at])
            while end < len(table) and (ids[0][end], ids[1][end], ids[2][end]) == key:
                if ids[3][end] not in seen:
                    seen.add(ids[3][end])
                    pick.append(end)
                end += 1
            if len(pick) > 1:
                out += one(*key, *[[c[k] for k in pick] for c in ids[3:]], [body[k].as_py() for k in pick])
            at = end
        cols = list(zip(*out)) or [(), (), ()]
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.binary(), pa.int64()))], names=["node", "hub", "links"])

    return run, schema


def similar(
    docs: DataFrame,
    words: int = WORDS,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    depth: int = DEPTH,
    recall: float = RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: ``class_id``, ``n_links``, ``n_copies``.

    ``class_id`` is the smallest ``doc_id`` that is reachable over equal texts and links of similarity
    ``threshold`` or more; ``n_links`` counts the different texts that the document's text is linked to and
    ``n_copies`` the rows with its very text.  A null text counts as empty; texts without words are linked to
    nothing but equal ones; a text of fewer than ``words`` words is one shingle.  Rows that repeat are copies.
    A class whose ``doc_id`` are all null has a null ``class_id``.
    """
    n_rows, text_bytes = text_stats(docs)
    texts = docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("node"), "text"
    )
    signer = _signer(words, trees, depth, threshold, recall)
    signed = materialize(texts.mapInArrow(signer, "doc_id long, node binary, need int, labels array<binary>"), "signed")
    # ``own`` names a class; rows without an id do not, but may have to lend their text.
    nodes = signed.groupBy("node").agg(
        F.min("doc_id").alias("doc_id"),
        F.min(F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))).alias("own"),
        F.count(F.lit(1)).alias("copies"),
        F.any_value("need").alias("need"),
        F.any_value("labels").alias("labels"),
    )
    nodes = materialize(nodes, "nodes")
    chosen, members = trie_nodes(nodes, depth, prefix_length(threshold, trees, depth, recall))
    met = skew_join(members, chosen, ["key"], "n", ["node"])
    parts = F.ceil(F.col("n") / F.lit(block)).cast("int")
    mine = met.groupBy("node", "doc_id").agg(F.collect_list(F.struct("key", parts.alias("g"))).alias("met"))
    bodies = texts.mapInArrow(_zip, "doc_id long, node binary, body binary")
    spread = (
        bodies.join(mine, ["doc_id", "node"])
        .select("node", "body", F.transform("met", lambda x: x["key"]).alias("mine"), F.explode("met").alias("m"))
        .select("node", "body", "mine", F.col("m.key").alias("bucket"), F.pmod(F.xxhash64("node"), F.col("m.g")).cast("int").alias("block"), F.col("m.g").alias("g"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
        .select("bucket", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "node", "mine", "body")
    )
    run, schema = _verifier(words, threshold)
    task = F.pmod(F.xxhash64("bucket", "a", "b"), F.lit(parts_of(text_bytes)))
    found = materialize(spread.withColumn("task", task).groupBy("task").applyInArrow(lambda t: run(t), schema), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    parents = connected_components(found, "node", "hub")
    linked = nodes.select("node", "own", "copies").join(links, "node", "left").join(parents, "node", "left")
    linked = linked.withColumn("component", F.coalesce("component", "node"))
    size = linked.groupBy("component").agg(F.min("own").alias("class_id"), F.count(F.lit(1)).alias("members"))
    named = skew_join(linked, size, ["component"], "members", ["node"]).select(
        "node", "copies", "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    )
    rows = signed.select("node", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"))
    return skew_join(rows, named, ["node"], "copies", ["doc_id"]).select("doc_id", "class_id", "n_links", F.col("copies").alias("n_copies"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class: that of its smallest ``doc_id``; rows without an id stay."""
    classes = materialize(similar(docs, **options).where("doc_id is not null").select("doc_id", "class_id"), "classes")
    # Rows that share the smallest id itself are copies too; one of them comes back.
    again = classes.where("doc_id = class_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    again = materialize(again, "again")
    kept = without(docs, classes.where("doc_id > class_id").select("doc_id").unionByName(again))
    if again.isEmpty():
        return kept
    once = docs.join(again, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    return kept.unionByName(once.select(*docs.columns))
