"""Which windows of a corpus occur more than once: sampled anchors, and an exchange of their hashes.

Two equal windows of ``width`` elements choose the same ``short``-element window inside them (the one with
the smallest hash, leftmost on ties).  A window can only repeat if its anchor does, so hashes of anchors, a
few per hundred elements, are exchanged first, and all later work is on windows with a repeated anchor.

Hashes travel in packets: a task sorts what it found in some thousand documents and sends one row per
bucket, a range of hash values, with arrays of hashes and places.  A hash that a task has met several times
goes out once, so what one bucket receives of a single hash is bounded by the number of packets, not by how
often a passage stands in the corpus.  Answers go back in one row per bucket and part, a part being the
documents with one remainder of a hash of ``doc_id``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import ROLL, mix, powers, running, slices

# Text bytes of one part (documents that meet again for the next step) and hashes of one bucket.
PART_BYTES = 2 << 20
BUCKET_HASHES = 500_000
# A task sends packets whenever it holds this many hashes or documents.
PACKET_HASHES = 250_000
PACKET_DOCS = 60_000
# The filter step compares 48 bits; later steps compare whole hashes and more.
FILTER_SHIFT = np.uint64(16)
HOT_PART = -1

PACKET = "bucket int, kind int, low binary, high binary, docs binary, places binary, far binary, keys binary, parts binary"
ANSWER = "part int, keys binary, counts binary, places binary"


def parts_of(text_bytes: int) -> int:
    return max(64, -(-text_bytes // PART_BYTES))


def zipped(docs: DataFrame, n_parts: int) -> DataFrame:
    """(part, key, doc_id, body): every row's text as compressed UTF-8, ready to be dealt into parts.

    ``key`` tells rows apart; only rows equal in ``doc_id`` and text share it.  Each later step reads this
    from one and the same exchange.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in slices(batches):
            body = [pack((t or "").encode()) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("part"), b.column("key"), b.column("doc_id"), pa.array(body, pa.binary())], names=["part", "key", "doc_id", "body"]
            )

    return keyed(docs, n_parts).mapInArrow(run, "part int, key long, doc_id long, body binary")


def keyed(docs: DataFrame, n_parts: int) -> DataFrame:
    return docs.select(
        F.pmod(F.xxhash64("doc_id"), F.lit(n_parts)).cast("int").alias("part"),
        F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("key"),
        "doc_id",
        "text",
    )


def unzipped(table: pa.Table, limit: int) -> Iterator[tuple[list[int], list[bytes]]]:
    """(row numbers, texts) of a part, a bounded number of bytes at a time."""
    unpack = zstandard.ZstdDecompressor().decompress
    rows, texts, size = [], [], 0
    for k, body in enumerate(table.column("body").to_pylist()):
        text = unpack(body)
        if rows and size + len(text) > limit:
            yield rows, texts
            rows, texts, size = [], [], 0
        rows.append(k)
        texts.append(text)
        size += len(text)
    if rows:
        yield rows, texts


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and where each begins (one more entry than texts)."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    return raw, np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))


def renamed(hashes: np.ndarray) -> np.ndarray:
    """Hashes of anchors spread anew: as the smallest of their windows they crowd at low values, where few
    buckets would get them all."""
    return mix(hashes + ROLL)


def starts_inside(first: np.ndarray, width: int) -> np.ndarray:
    """Start of every window of ``width`` elements that stays inside its document."""
    count = np.maximum(np.diff(first) - width + 1, 0)
    return np.repeat(first[:-1] - np.cumsum(count) + count, count) + np.arange(count.sum())


def anchors(elements: np.ndarray, first: np.ndarray, width: int, short: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(window starts, the anchor's place in each, hashes of the short windows, running hash).

    ``elements`` are 64-bit values (of bytes or words), ``first`` says where documents begin.
    """
    n = len(elements)
    run = running(elements)
    starts = starts_inside(first, width)
    if not len(starts):
        return starts, starts, np.empty(0, np.uint64), run
    hashes = mix((run[short:] - run[: n - short + 1]) * powers(n + 1)[1][: n - short + 1])
    low = hashes & np.uint64(0xFFFFFFFF00000000)
    low |= np.arange(len(low), dtype=np.uint64)
    span, reach = width - short + 1, 1
    while 2 * reach <= span:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < span:
        low = np.minimum(low[: len(low) - (span - reach)], low[span - reach :])
    return starts, (low[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64), hashes, run


class Sender:
    """Collects (hash, document, place) and turns them into packets.

    A hash met once is a row of kind 0.  One met several times is known to repeat: its places are sent back
    at once (kind 2), and only the hash and their number go to its bucket (kind 1).  Unless ``whole``, 48
    bits of a hash are sent, else all 64 and 32 of a second one.
    """

    def __init__(self, n_buckets: int, whole: bool):
        self.n_buckets, self.whole = n_buckets, whole
        self.held: list[tuple[np.ndarray, ...]] = []
        self.keys: list[np.ndarray] = []
        self.parts: list[np.ndarray] = []
        self.n_hashes = self.n_docs = self.n_sent = 0

    def add(self, hashes: np.ndarray, checks: np.ndarray, docs: np.ndarray, places: np.ndarray, keys: np.ndarray, parts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """``docs`` counts within ``keys`` and ``parts``, those of the documents looked at."""
        if self.n_docs and self.n_docs + len(keys) > PACKET_DOCS:
            yield from self.flush()
        self.held.append((hashes, checks, docs.astype(np.uint32) + np.uint32(self.n_docs), places.astype(np.uint32)))
        self.keys.append(keys)
        self.parts.append(parts)
        self.n_hashes += len(hashes)
        self.n_docs += len(keys)
        if self.n_hashes > PACKET_HASHES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.n_hashes:
            h, c, d, p = (np.concatenate(x) for x in zip(*self.held))
            keys, parts = np.concatenate(self.keys), np.concatenate(self.parts)
            order = np.lexsort((c, h)) if self.whole else np.argsort(h, kind="stable")
            h, c, d, p = h[order], c[order], d[order], p[order]
            same = np.zeros(len(h) + 1, bool)
            same[1:-1] = (h[1:] == h[:-1]) & ((c[1:] == c[:-1]) if self.whole else True)
            several = same[1:] | same[:-1]
            lead = several & ~same[:-1]
            rows = []
            number = np.diff(np.r_[np.flatnonzero(~same[:-1]), len(h)]).astype(np.uint32)
            number = number[np.cumsum(~same[:-1]) - 1]
            for kind, pick in ((0, ~several), (1, lead)):
                hk, ck, dk, pk = h[pick], c[pick], (number if kind else d)[pick], p[pick]
                bucket = ((hk >> np.uint64(32)) * np.uint64(self.n_buckets) >> np.uint64(32)).astype(np.int32)
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(bucket)]) if len(bucket) else ():
                    rows.append(self.packet(int(bucket[a]), kind, hk[a:b], ck[a:b], dk[a:b], pk[a:b], keys, parts))
            if several.any():
                # Any bucket can pass answers on; packets take turns.
                task = TaskContext.get()
                at = (self.n_sent + (task.partitionId() if task else 0)) % self.n_buckets
                rows.append(self.packet(at, 2, h[:0], c[:0], d[several], p[several], keys, parts))
            self.n_sent += 1
            names = [x.split()[0] for x in PACKET.split(", ")]
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 7]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=names)
        self.held, self.keys, self.parts, self.n_hashes, self.n_docs = [], [], [], 0, 0

    def packet(self, bucket: int, kind: int, h: np.ndarray, c: np.ndarray, d: np.ndarray, p: np.ndarray, keys: np.ndarray, parts: np.ndarray) -> tuple:
        if self.whole:
            low, high = h.tobytes(), c.astype(np.uint32).tobytes()
        else:
            h = h >> FILTER_SHIFT
            low, high = h.astype(np.uint32).tobytes(), (h >> np.uint64(32)).astype(np.uint16).tobytes()
        if kind == 1:
            d, p = d[:0], d
        used, d = np.unique(d, return_inverse=True)
        return (
            bucket, kind, low, high, d.astype(np.uint16).tobytes(), (p & 0xFFFF).astype(np.uint16).tobytes(), (p >> np.uint32(16)).astype(np.uint16).tobytes(),
            keys[used].astype(np.int64).tobytes(), parts[used].astype(np.int32).tobytes(),
        )


def answers(parts: np.ndarray, keys: np.ndarray, places: np.ndarray, kind: type = np.uint32) -> pa.Table:
    """One row per part: keys, how many places each has, and the places."""
    order = np.lexsort((places, keys, parts))
    parts, keys, places = parts[order], keys[order], places[order]
    rows = []
    cuts = np.flatnonzero(np.diff(parts)) + 1
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(parts)]) if len(parts) else ():
        turn = np.flatnonzero(np.diff(keys[a:b])) + 1
        begin = np.r_[0, turn]
        counts = np.diff(np.r_[begin, b - a]).astype(np.uint32)
        rows.append((int(parts[a]), keys[a:b][begin].tobytes(), counts.tobytes(), places[a:b].astype(kind).tobytes()))
    cols = list(zip(*rows)) or [(), (), (), ()]
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.table([pa.array(x, t) for x, t in zip(cols, kinds)], names=["part", "keys", "counts", "places"])


def _answerer(whole: bool, hot: int):
    def run(table: pa.Table) -> pa.Table:
        nothing = np.empty(0, np.int64)
        hs, cs, times, part, key, place = ([nothing] for _ in range(6))
        always: list[tuple[np.ndarray, ...]] = []
        single = []
        for r in table.to_pylist():
            low = np.frombuffer(r["low"], np.uint64 if whole else np.uint32).astype(np.uint64)
            high = np.frombuffer(r["high"], np.uint32 if whole else np.uint16).astype(np.uint64)
            d = np.frombuffer(r["docs"], np.uint16)
            p = np.frombuffer(r["places"], np.uint16).astype(np.uint32) | np.frombuffer(r["far"], np.uint16).astype(np.uint32) << np.uint32(16)
            of_part, of_key = np.frombuffer(r["parts"], np.int32), np.frombuffer(r["keys"], np.int64)
            if r["kind"] == 2:
                always.append((of_part[d], of_key[d], p))
                continue
            hs.append(low if whole else low | high << np.uint64(32))
            cs.append(high)
            single.append(np.full(len(low), r["kind"] == 0))
            times.append(p if r["kind"] == 1 else np.ones(len(low), np.int64))
            if r["kind"] == 0:
                part.append(of_part[d]), key.append(of_key[d]), place.append(p)
        out = []
        if single:
            h, c, one, n = np.concatenate(hs).astype(np.uint64), np.concatenate(cs).astype(np.uint64), np.concatenate(single), np.concatenate(times)
            order = np.lexsort((c, h)) if whole else np.argsort(h, kind="stable")
            h, c, n = h[order], c[order], n[order]
            new = np.r_[True, (h[1:] != h[:-1]) | (c[1:] != c[:-1] if whole else False)]
            total = np.add.reduceat(n, np.flatnonzero(new))
            found = np.empty(len(h), bool)
            found[order] = (total > 1)[np.cumsum(new) - 1]
            found = found[one]
            always.append(tuple(np.concatenate(x)[found] for x in (part, key, place)))
            if hot and (total > hot).any():
                out.append(answers(np.full((total > hot).sum(), HOT_PART), h[new][total > hot].view(np.int64), total[total > hot]))
        out.append(answers(*(np.concatenate(x) for x in zip(*always))) if always else answers(nothing, nothing, nothing))
        return pa.concat_tables(out)

    return run


def repeated(packets: DataFrame, whole: bool = False, hot: int = 0) -> DataFrame:
    """Answers (rows of ``ANSWER``) for the places of all hashes that occur at least twice.

    With ``hot``, rows of part ``HOT_PART`` list (as keys) the hashes that occur more than ``hot`` times.
    """
    return packets.groupBy("bucket").applyInArrow(_answerer(whole, hot), ANSWER)


def first_packets(docs: DataFrame, n_parts: int, n_buckets: int, find) -> DataFrame:
    """Packets for the anchors of all texts; ``find(batch)`` yields (hashes, documents, places) of bounded pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = Sender(n_buckets, whole=False)
        for batch in batches:
            for piece, hashes, docs_at, places in find(batch):
                keys, parts = np.asarray(piece.column("key")), np.asarray(piece.column("part"))
                yield from sender.add(hashes, np.zeros(len(hashes), np.uint32), docs_at, places, keys, parts)
        yield from sender.flush()

    return keyed(docs, n_parts).mapInArrow(run, PACKET)


class Answers:
    """The answers of one part, by document key."""

    def __init__(self, table: pa.Table, kind: type = np.uint32):
        keys, places = [np.empty(0, np.int64)], [np.empty(0, kind)]
        for k, c, p in zip(*(table.column(x).to_pylist() for x in ("keys", "counts", "places"))):
            keys.append(np.repeat(np.frombuffer(k, np.int64), np.frombuffer(c, np.uint32)))
            places.append(np.frombuffer(p, kind))
        key, place = np.concatenate(keys), np.concatenate(places)
        order = np.argsort(key, kind="stable")
        self.keys, self.places = key[order], place[order]

    def of(self, keys: Iterable[int]) -> Iterator[np.ndarray]:
        wanted = np.fromiter(keys, np.int64)
        for a, b in zip(np.searchsorted(self.keys, wanted, "left"), np.searchsorted(self.keys, wanted, "right")):
            yield self.places[a:b].astype(np.int64)


def alive_at(found: Answers, keys: list[int], first: np.ndarray) -> np.ndarray:
    """A mark at every element where a repeated anchor of these documents begins."""
    out = np.zeros(int(first[-1]), bool)
    for at, places in zip(first[:-1].tolist(), found.of(keys)):
        out[at + places] = True
    return out
