"""Removal of repeated word windows by level-wise doubling.

Level one takes windows of half the wanted length; those that repeat, and only those, are extended to the
whole length (at most twice theirs) and compared again; what survives repeats at the whole length.  Level
one looks at one window in each stretch of starts (see ``repeats``), which loses nothing: two equal long
windows contain the same sampled short one.  ``longest_repeats`` goes on doubling beyond that length until no
candidates survive and says how long the repeats of each document are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import repeats
from corpusloom.llm.common import SLICE_BYTES, running, slices, text_stats, utf8, window_hash, word_hashes

WIDTH = 35
# Sampled windows per text byte are about 1 / (6 * 10); two to one leaves room in the buckets.
BYTES_PER_HASH = 60
# Base of the second, independent hash of long windows.
CHECK_BASE = 0xD6E8FEB86659FD93
OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _short(width: int) -> int:
    return -(-width // 2)


def _first_level(width: int):
    def find(batch: pa.RecordBatch):
        for piece in slices([batch]):
            words, first = word_hashes(*utf8(piece.column("text")))
            _, at, hashes, _ = repeats.anchors(words, first, width, _short(width))
            at = at[np.r_[True, at[1:] != at[:-1]]] if len(at) else at
            doc = np.searchsorted(first, at, "right") - 1
            yield piece, repeats.renamed(hashes[at]), doc, at - first[doc]

    return find


def _candidates(rows: pa.Table, found: repeats.Answers, width: int):
    """For bounded pieces of a part: (keys, first word of each document, words, starts of windows whose
    sampled half repeats)."""
    keys = rows.column("key").to_pylist()
    for at, texts in repeats.unzipped(rows, SLICE_BYTES):
        own = [keys[k] for k in at]
        words, first = word_hashes(*repeats.joined(texts))
        starts, anchor, _, run = repeats.anchors(words, first, width, _short(width))
        alive = repeats.alive_at(found, own, first)
        yield own, first, words, starts[alive[anchor]] if len(starts) else starts, run


def _second_level(width: int, n_buckets: int):
    def run(rows: pa.Table, level: pa.Table) -> pa.Table:
        sender, out = repeats.Sender(n_buckets, whole=True), []
        part = rows.column("part")[0].as_py() if len(rows) else 0
        for keys, first, words, starts, whole in _candidates(rows, repeats.Answers(level), width):
            doc = np.searchsorted(first, starts, "right") - 1
            hashes = window_hash(whole, starts, starts + width)
            check = window_hash(running(words, CHECK_BASE), starts, starts + width, CHECK_BASE)
            send = sender.add(hashes, check.astype(np.uint32), doc, starts - first[doc], np.array(keys, np.int64), np.full(len(keys), part, np.int32))
            out += list(send)
        out += list(sender.flush())
        names = [c.split()[0] for c in repeats.PACKET.split(", ")]
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 7]
        return pa.Table.from_batches(out) if out else pa.table([pa.array([], t) for t in kinds], names=names)

    return run


def _remover(width: int):
    def run(rows: pa.Table, marks: pa.Table) -> pa.Table:
        found, out = repeats.Answers(marks), []
        ids, keys = rows.column("doc_id").to_pylist(), rows.column("key").to_pylist()
        for at, texts in repeats.unzipped(rows, SLICE_BYTES):
            for k, text, places in zip(at, texts, found.of([keys[k] for k in at])):
                words = text.split()  # bytes.split parts at exactly the white space that word_bounds knows
                n = len(words)
                if len(places):
                    edge = np.zeros(n + 1, np.int64)
                    places = np.unique(places)
                    edge[places] += 1
                    np.subtract.at(edge, places + width, 1)
                    words = [w for w, hit in zip(words, np.cumsum(edge)[:n].tolist()) if not hit]
                out.append((ids[k], n, n - len(words), hashlib.sha256(b" ".join(words)).hexdigest()))
        cols = list(zip(*out)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.table([pa.array(c, t) for c, t in zip(cols, kinds)], names=[c.split()[0] for c in OUT.split(", ")])

    return run


def _levels(docs: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """(texts dealt into parts, answers: starts of the windows of ``width`` words that occur elsewhere)."""
    _, text_bytes = text_stats(docs)
    n_parts = repeats.parts_of(text_bytes)
    n_buckets = max(16, -(-text_bytes // (BYTES_PER_HASH * repeats.BUCKET_HASHES) * 2))
    level = repeats.repeated(repeats.first_packets(docs, n_parts, n_buckets, _first_level(width)))
    texts = repeats.zipped(docs, n_parts)
    # Whole-length windows that pass level one are at most all words; a sixth of the bytes is their bound.
    wide = max(16, -(-text_bytes // (6 * repeats.BUCKET_HASHES)))
    packets = texts.groupBy("part").cogroup(level.groupBy("part")).applyInArrow(_second_level(width, wide), repeats.PACKET)
    return texts, repeats.repeated(packets, whole=True)


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Drop every word inside a window of ``width`` words that also starts anywhere else in ``docs``.

    Windows are judged on the input, in the same document and in others.  Words are runs of characters other
    than space and the controls from tab to carriage return.  A null text has no words; texts shorter than
    ``width`` words lose none; a row that repeats counts as a document of its own, so both copies lose all
    their windows; rows without a ``doc_id`` are treated alike.  An empty table gives an empty table.
    """
    texts, marks = _levels(docs, width)
    return texts.groupBy("part").cogroup(marks.groupBy("part")).applyInArrow(_remover(width), OUT)


def longest_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, width): per document the greatest of width, 2 width, 4 width, ... at which it still repeats."""
    out, level = None, width
    while True:
        done = remove_repeats(docs, level).where("n_removed > 0").select("doc_id", F.lit(level).alias("width"))
        n = done.count()
        if out is None:
            out = done
        if not n:
            return out.groupBy("doc_id").agg(F.max("width").alias("width"))
        out = out.unionByName(done)
        # Only documents that repeat at this length can repeat at twice the length.
        docs = docs.join(done.select("doc_id").distinct(), "doc_id", "left_semi")
        level *= 2

