"""Removal of later copies of byte strings by longest-previous-factor arrays.

A string of ``width`` bytes is removed where it also starts in a document with a smaller ``doc_id``.  Texts
never stand whole in one place; what has to be compared is brought together by content.  Every string has an
anchor (see ``repeats``); strings with a repeated anchor travel, as contexts of less than twice ``width``
bytes around it, to the bucket of the anchor's hash, where equal strings are bound to meet.  Equal contexts
are settled by the smallest ``doc_id`` among them.  The different contexts of a bucket are laid out in order
of that ``doc_id``, their suffixes are sorted by prefix doubling, and the longest previous factor of every
suffix follows from its neighbours in suffix order: with equal suffixes in text order, the previous smaller
position stands directly before it, and none follows.  Where it reaches ``width`` and lies in a smaller
document, the string is a later copy.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import repeats
from corpusloom.llm.common import materialize, random_table, running, slices, text_stats, utf8, window_hash

WIDTH = 50
SHORT = 20
# Bytes looked at together; eight-byte values are held for each.
SLICE = 400_000
# One anchor is chosen for about 16 bytes.
BYTES_PER_HASH = 16
CONTEXT = (
    "bucket int, kind int, part int, leads binary, sizes binary, docs binary, places binary, far binary, "
    "keys binary, ids binary, body binary"
)
RANGES = "part int, keys binary, counts binary, places binary"
OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
NO_ID = np.iinfo(np.int64).min
# The lead of a string that travels by itself, not with its anchor.
ALONE = (1 << 16) - 1
# Base of the second hash of strings.
CHECK_BASE = 0xD6E8FEB86659FD93
# An anchor is hot above this many places.  Only to bound the list of hot anchors (32 MB) the number grows with the
# corpus where it has more than HOT_PLACES * HOT_SHARE bytes (84 GB).
HOT_PLACES, HOT_SHARE = 20_000, 1 << 22


def _find(width: int, short: int):
    def find(batch: pa.RecordBatch):
        values = random_table(1)
        for piece in slices([batch], limit=SLICE):
            raw, first = utf8(piece.column("text"))
            _, at, hashes, _ = repeats.anchors(values[raw], first, width, short)
            at = at[np.r_[True, at[1:] != at[:-1]]] if len(at) else at
            doc = np.searchsorted(first, at, "right") - 1
            yield piece, repeats.renamed(hashes[at]), doc, at - first[doc]

    return find


def _empty(schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    pairs = [c.split() for c in schema.split(", ")]
    return pa.table([pa.array([], kinds[k]) for _, k in pairs], names=[n for n, _ in pairs])


def _table(rows: list[tuple], schema: str) -> pa.Table:
    empty = _empty(schema)
    if not rows:
        return empty
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), empty.schema)], names=empty.column_names)


def _runs(starts: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each stretch of neighbouring strings that share their anchor."""
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.r_[True, (starts[1:] != starts[:-1] + 1) | (anchor[1:] != anchor[:-1])]
    begin = np.flatnonzero(new)
    return begin, np.r_[begin[1:], len(starts)] - 1


def _gather(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes [start, start + size) one after the other."""
    total = int(size.sum())
    at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(total)
    return raw[at]


def _distinct(columns: tuple[np.ndarray, ...], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, first rows of groups, group numbers) of rows sorted by columns and then by document."""
    order = np.lexsort((ids, *columns))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def _contexts(width: int, short: int, n_buckets: int, hot: np.ndarray):
    """From the texts and repeated anchors of a part, packets of contexts for the buckets of their anchors.

    Strings with an anchor in ``hot`` (ascending hashes that very many places share) travel one by one to the buckets
    of their own hashes, so that no bucket gathers all surroundings of a common phrase (their lead is ALONE).
    """

    def pieces(rows: pa.Table, level: pa.Table):
        """(row, place, size, lead, anchor hash, context hash, bytes, their ends) of bounded pieces."""
        values, found = random_table(1), repeats.Answers(level)
        keys = rows.column("key").to_pylist()
        for at, texts in repeats.unzipped(rows, SLICE):
            raw, first = repeats.joined(texts)
            starts, anchor, hashes, run = repeats.anchors(values[raw], first, width, short)
            if not len(starts):
                continue
            live = repeats.alive_at(found, [keys[k] for k in at], first)[anchor]
            starts, anchor = starts[live], anchor[live]
            common = np.zeros(len(starts), bool)
            if len(hot):
                name = repeats.renamed(hashes[anchor]) >> repeats.FILTER_SHIFT
                common = hot[np.minimum(np.searchsorted(hot, name), len(hot) - 1)] == name
            alone, starts, anchor = starts[common], starts[~common], anchor[~common]
            begin, end = _runs(starts, anchor)
            lo, size, a = starts[begin], starts[end] - starts[begin] + width, anchor[begin]
            lead, ah = a - lo, repeats.renamed(hashes[a])
            if len(alone):
                lo, size = np.r_[lo, alone], np.r_[size, np.full(len(alone), width)]
                lead, ah = np.r_[lead, np.full(len(alone), ALONE)], np.r_[ah, window_hash(run, alone, alone + width)]
            if len(lo):
                doc = np.searchsorted(first, lo, "right") - 1
                yield np.array(at)[doc], lo - first[doc], size, lead, ah, window_hash(run, lo, lo + size), _gather(raw, lo, size)

    def run(rows: pa.Table, level: pa.Table) -> pa.Table:
        got = list(pieces(rows, level))
        if not got:
            return _empty(CONTEXT)
        row, place, size, lead, ah, ch, body = (np.concatenate(x) for x in zip(*got))
        offset = np.cumsum(size) - size
        keys = np.array(rows.column("key").to_pylist(), np.int64)
        ids = np.array([NO_ID if x is None else x for x in rows.column("doc_id").to_pylist()], np.int64)
        part = rows.column("part")[0].as_py()
        # Equal contexts in this part: all but those of the smallest document are later copies already.
        order, head, group = _distinct((size, lead, ch, ah), ids[row])
        row, place, size, lead, ah, offset = (x[order] for x in (row, place, size, lead, ah, offset))
        later = ids[row] > ids[row][head][group]
        bucket = ((ah >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int32)
        # Their ranges only pass through a bucket, any bucket, on the way back to the part.
        bucket[later] = part % n_buckets
        pack, out = zstandard.ZstdCompressor(level=1).compress, []
        for kind, pick in ((0, ~later), (1, later)):
            chosen = np.flatnonzero(pick)
            for b in np.split(chosen, np.flatnonzero(np.diff(bucket[chosen])) + 1) if len(chosen) else ():
                used, d = np.unique(row[b], return_inverse=True)
                text = pack(_gather(body, offset[b], size[b]).tobytes()) if kind == 0 else b""
                out.append((
                    int(bucket[b[0]]), kind, part, lead[b].astype(np.uint16).tobytes(), size[b].astype(np.uint16).tobytes(),
                    d.astype(np.uint16 if len(used) < 1 << 16 else np.uint32).tobytes(), (place[b] & 0xFFFF).astype(np.uint16).tobytes(),
                    (place[b] >> 16).astype(np.uint16).tobytes(), keys[used].tobytes(), ids[used].tobytes(), text,
                ))
        return _table(out, CONTEXT)

    return run


def suffix_runs(text: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes at positions ``at`` whose first ``width`` bytes are not unique, in suffix order (equal ones in
    text order), and the number of the run of equal ones that each belongs to.

    The order is refined by eight bytes at a time; suffixes that no other one equals so far fall out.
    """
    eight = np.lib.stride_tricks.sliding_window_view(np.concatenate([text, np.zeros(8, np.uint8)]), 8)
    some, run = np.arange(len(at)), np.zeros(len(at), np.int64)
    for k in range(0, width, 8):
        step = min(k, max(width - 8, 0))
        word = np.ascontiguousarray(eight[at[some] + step]).view(">u8").ravel().astype(np.uint64)
        if width < 8:
            word >>= np.uint64(64 - 8 * width)
        order = np.lexsort((word, run))
        some, run, word = some[order], run[order], word[order]
        new = np.ones(len(run), bool)
        new[1:] = (run[1:] != run[:-1]) | (word[1:] != word[:-1])
        run = np.cumsum(new) - 1
        several = np.bincount(run, minlength=1)[run] > 1
        some, run = some[several], run[several]
    return some, run


def previous_factors(text: np.ndarray, at: np.ndarray, owner: np.ndarray, width: int) -> np.ndarray:
    """For suffixes at ascending positions ``at`` in documents ``owner`` (ascending too): does the longest
    previous factor from an earlier document reach ``width``?  Among equal suffixes in text order the previous
    smaller position stands directly before, so following it leads to the first of the run, the earliest."""
    some, run = suffix_runs(text, at, width)
    out = np.zeros(len(at), bool)
    if len(some):
        head = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        earliest = np.repeat(owner[some][head], np.diff(np.r_[head, len(run)]))
        out[some] = earliest < owner[some]
    return out


def _rivals(ah: np.ndarray, run: np.ndarray, offset: np.ndarray, size: np.ndarray, lead: np.ndarray, width: int, short: int) -> np.ndarray:
    """Which different contexts may share a string with another one.

    A string is its anchor and ``width - short`` bytes around it, so two contexts that share one agree in
    half as many bytes to the left of the anchor, or to the right.
    """
    half = (width - short) // 2
    may = np.zeros(len(ah), bool)
    mid = offset + lead
    for able, lo, hi in ((lead >= half, mid - half, mid + short), (size - lead - short >= half, mid, mid + short + half)):
        able = np.flatnonzero(able & (lead != ALONE))
        if len(able):
            side = window_hash(run, lo[able], hi[able])
            _, at, times = np.unique(side, return_inverse=True, return_counts=True)
            may[able[times[at] > 1]] = True
    return may


def _judge(width: int, short: int):
    def run(table: pa.Table) -> pa.Table:
        """Ranges [place, place + size) to remove, for the contexts of one bucket."""
        unpack = zstandard.ZstdDecompressor().decompress
        got: list[tuple[np.ndarray, ...]] = []
        done: list[tuple[np.ndarray, ...]] = []
        bodies: list[np.ndarray] = []
        for r in table.to_pylist():
            size, keys = np.frombuffer(r["sizes"], np.uint16).astype(np.int64), np.frombuffer(r["keys"], np.int64)
            d = np.frombuffer(r["docs"], np.uint16 if len(keys) < 1 << 16 else np.uint32)
            place = np.frombuffer(r["places"], np.uint16).astype(np.int64) | np.frombuffer(r["far"], np.uint16).astype(np.int64) << 16
            part = np.full(len(size), r["part"], np.int32)
            if r["kind"] == 1:
                done.append((part, keys[d], place, size))
                continue
            got.append((np.frombuffer(r["leads"], np.uint16).astype(np.int64), size, np.frombuffer(r["ids"], np.int64)[d], part, keys[d], place))
            bodies.append(np.frombuffer(unpack(r["body"]), np.uint8))
        if got:
            lead, size, ids, part, key, place = (np.concatenate(x) for x in zip(*got))
            body = np.concatenate(bodies)
            offset = np.cumsum(size) - size
            sums = running(random_table(1)[body])
            ch = window_hash(sums, offset, offset + size)
            alone = lead == ALONE
            mid = np.where(alone, offset, offset + lead)
            # A string that travels alone is told from others by two hashes of all its bytes.
            ah = repeats.renamed(window_hash(sums, mid, np.where(alone, offset + size, mid + short)))
            if alone.any():
                other = running(random_table(1)[body], CHECK_BASE)
                ah[alone] = window_hash(other, offset[alone], offset[alone] + size[alone], CHECK_BASE)
            order, head, group = _distinct((size, lead, ch, ah), ids)
            ah, lead, size, ids, part, key, place, offset = (x[order] for x in (ah, lead, size, ids, part, key, place, offset))
            later = ids > ids[head][group]
            done.append((part[later], key[later], place[later], size[later]))
            # Different contexts of one anchor may still share strings.
            rivals = head[_rivals(ah[head], sums, offset[head], size[head], lead[head], width, short)]
            rivals = rivals[np.argsort(ids[rivals], kind="stable")]
            if len(rivals):
                text = _gather(body, offset[rivals], size[rivals])
                begin = np.cumsum(size[rivals]) - size[rivals]
                count = size[rivals] - width + 1
                at = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
                which = np.repeat(np.arange(len(rivals)), count)
                hit = previous_factors(text, at, ids[rivals][which], width)
                a, b = _runs(at[hit], which[hit])
                at, which = at[hit], which[hit]
                if len(a):
                    # The range holds for every row of that context and smallest document.
                    at0, row, n = at[a] - begin[which[a]], rivals[which[a]], at[b] - at[a] + width
                    reps = np.bincount(group[~later])[group[row]]
                    rows = np.repeat(row - np.cumsum(reps) + reps, reps) + np.arange(reps.sum())
                    done.append((part[rows], key[rows], place[rows] + np.repeat(at0, reps), np.repeat(n, reps)))
        if not done:
            return _empty(RANGES)
        part, key, place, size = (np.concatenate(x) for x in zip(*done))
        # Place and size of a range travel as one number.
        return repeats.answers(part, key, place.astype(np.uint64) << np.uint64(32) | size.astype(np.uint64), np.uint64)

    return run


def _remover():
    def run(rows: pa.Table, ranges: pa.Table) -> pa.Table:
        found, out = repeats.Answers(ranges, np.uint64), []
        ids, keys = rows.column("doc_id").to_pylist(), rows.column("key").to_pylist()
        for at, texts in repeats.unzipped(rows, SLICE):
            for k, text, pairs in zip(at, texts, found.of([keys[k] for k in at])):
                n_removed = n_spans = 0
                kept = text
                if len(pairs):
                    lo, size = pairs >> 32, pairs & 0xFFFFFFFF
                    edge = np.zeros(len(text) + 1, np.int64)
                    np.add.at(edge, lo, 1)
                    np.subtract.at(edge, lo + size, 1)
                    gone = np.cumsum(edge)[:-1] > 0
                    n_removed = int(gone.sum())
                    n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                out.append((ids[k], len(text), n_removed, n_spans, hashlib.sha256(kept).hexdigest()))
        return _table(out, OUT)

    return run


def remove_later_copies(docs: DataFrame, width: int = WIDTH, short: int = SHORT) -> DataFrame:
    """Drop every byte inside a string of ``width`` bytes that also starts in a document of smaller ``doc_id``.

    Strings are judged on the input and never cross documents.  A null text is empty, texts below ``width``
    bytes keep all; a null ``doc_id`` counts as smaller than any other; rows that share a ``doc_id`` never
    remove from each other, so repeated rows are treated alike.  An empty table gives an empty table.
    """
    _, text_bytes = text_stats(docs)
    n_parts = repeats.parts_of(text_bytes)
    n_buckets = max(16, -(-text_bytes // (BYTES_PER_HASH * repeats.BUCKET_HASHES)))
    least = max(HOT_PLACES, text_bytes // HOT_SHARE)
    level = materialize(repeats.repeated(repeats.first_packets(docs, n_parts, n_buckets, _find(width, short)), hot=least), "anchors")
    # At most one byte in ``least`` starts a hot anchor, which bounds this list.
    rows = level.where(F.col("part") == repeats.HOT_PART).select("keys").collect()
    hot = np.unique(np.concatenate([np.empty(0, np.uint64), *(np.frombuffer(r["keys"], np.uint64) for r in rows)]))
    level = level.where(F.col("part") != repeats.HOT_PART)
    texts = repeats.zipped(docs, n_parts)
    # A bucket of contexts holds whole bytes, about eighty for an anchor, but only of repeated ones.
    wide = 4 * n_buckets
    contexts = texts.groupBy("part").cogroup(level.groupBy("part")).applyInArrow(_contexts(width, short, wide, hot), CONTEXT)
    ranges = contexts.groupBy("bucket").applyInArrow(_judge(width, short), RANGES)
    return texts.groupBy("part").cogroup(ranges.groupBy("part")).applyInArrow(_remover(), OUT)
