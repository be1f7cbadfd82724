"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are sequences of lower-case words (runs of letters and digits).  Windows of
``min_match`` words that a document shares with an item are the seeds.  Where there are seeds, the longest
common runs are marked first, by Karp-Rabin scans of falling length, and never overlap; what they cover of
the item, in whatever order, is its coverage.  A document that covers ``threshold`` of an item is
contaminated by it, so passages whose parts were moved around are found too.

The items travel to the tasks in blocks of at most ``block_bytes`` of text, one pass over the documents
for each block, so no broadcast grows with the benchmark and nothing is shuffled but the few findings.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import plain_words, running, slices, window_hash, without

MIN_MATCH = 5
THRESHOLD = 0.6
BLOCK_BYTES = 8 << 20
SCHEMA = "doc_id long, item_id long, coverage double, n_tiles int, matched_words int, item_words int"
# Slots of the first, approximate test of a window.
FILTER_BITS = 22


def windows_of(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every window of ``size`` words that stays inside its text."""
    count = np.maximum(np.diff(first) - size + 1, 0)
    at = np.repeat(first[:-1] - np.cumsum(count) + count, count) + np.arange(count.sum())
    return at, window_hash(running(words), at, at + size)


def _free(used: np.ndarray) -> np.ndarray:
    """How many unmarked words follow from each place on."""
    at = np.arange(len(used))
    return np.minimum.accumulate(np.where(used, at, len(used))[::-1])[::-1] - at


def _common(run_a: np.ndarray, a: np.ndarray, run_b: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Lengths, up to ``most``, of the common runs from places ``a`` and ``b`` on, by halving with window hashes."""
    low, high = np.zeros(len(a), np.int64), most.copy()
    while (low < high).any():
        mid = (low + high + 1) // 2
        same = window_hash(run_a, a, a + mid) == window_hash(run_b, b, b + mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def tile(item: list[int], text: list[int], min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (item start, text start, length), longest matches first, none overlapping.

    A scan looks at the places where a common run can begin, those whose words before differ or are marked, and not
    at every two equal windows; words that repeat cost no more than others.
    """
    words, number = np.unique(np.array([*item, *text], np.uint64), return_inverse=True)
    number = number.ravel() + 2
    before_i, before_t = number[: len(item)], number[len(item) :]
    run_i, run_t = running(np.array(item, np.uint64)), running(np.array(text, np.uint64))
    used_i, used_t = np.zeros(len(item), bool), np.zeros(len(text), bool)
    kinds = len(words) + 2
    tiles: list[tuple[int, int, int]] = []

    def starts(used: np.ndarray, names: np.ndarray, size: int, none: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unmarked windows, the word before each (``none`` where there is none to extend to), and what is free there."""
        free = _free(used)
        at = np.flatnonzero(free >= size)
        last = np.where(at > 0, names[at - 1], none)
        last[(at > 0) & used[at - 1]] = none
        return at, last, free

    def scan(size: int) -> list[tuple[int, int, int]]:
        """Maximal unmarked common runs of at least ``size`` words, longest first."""
        at_i, last_i, free_i = starts(used_i, before_i, size, 0)
        at_t, last_t, free_t = starts(used_t, before_t, size, 1)
        if not len(at_i) or not len(at_t):
            return []
        names, of_i = np.unique(window_hash(run_i, at_i, at_i + size), return_inverse=True)
        hash_t = window_hash(run_t, at_t, at_t + size)
        of_t = np.minimum(np.searchsorted(names, hash_t), len(names) - 1)
        met = names[of_t] == hash_t
        at_t, last_t, of_t = at_t[met], last_t[met], of_t[met]
        key = of_i.ravel() * kinds + last_i
        order = np.argsort(key, kind="stable")
        key, at_i = key[order], at_i[order]
        lo, hi = np.searchsorted(key, of_t * kinds), np.searchsorted(key, (of_t + 1) * kinds)
        same_lo, same_hi = np.searchsorted(key, of_t * kinds + last_t), np.searchsorted(key, of_t * kinds + last_t, "right")
        found_i, found_t = [], []
        for a, b in ((lo, same_lo), (same_hi, hi)):
            n = b - a
            found_t.append(np.repeat(at_t, n))
            found_i.append(at_i[np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())])
        i, t = np.concatenate(found_i), np.concatenate(found_t)
        n = _common(run_i, i, run_t, t, np.minimum(free_i[i], free_t[t]))
        order = np.lexsort((t, i, -n))
        return list(zip(n[order].tolist(), i[order].tolist(), t[order].tolist()))

    size = max(min_match, min(len(item), len(text)))
    while True:
        for n, i, t in scan(size):
            if used_i[i : i + n].any() or used_t[t : t + n].any():
                break  # what is left of it may be the longest now: scan again
            used_i[i : i + n] = used_t[t : t + n] = True
            tiles.append((i, t, n))
        else:
            if size == min_match:
                return tiles
            size = max(min_match, size // 2)


def _blocks(items: DataFrame, limit: int) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    for r in items.select("item_id", "text").where("text is not null").toLocalIterator():
        n = len(r.text.encode())
        if block and size + n > limit:
            yield block
            block, size = [], 0
        block.append((r.item_id, r.text))
        size += n
    if block:
        yield block


def _searcher(block: list[tuple[int, str]], min_match: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, first = plain_words(pa.array([t for _, t in block], pa.string()))
        at, windows = windows_of(words, first, min_match)
        owner = np.searchsorted(first, at, "right") - 1
        # A window that an item repeats is one seed of it.
        order = np.lexsort((owner, windows))
        seeds, owners = windows[order], owner[order]
        new = np.r_[True, (seeds[1:] != seeds[:-1]) | (owners[1:] != owners[:-1])] if len(seeds) else np.empty(0, bool)
        seeds, owners = seeds[new], owners[new]
        coarse = np.zeros(1 << FILTER_BITS, bool)
        coarse[seeds >> np.uint64(64 - FILTER_BITS)] = True
        of_item = [words[a:b].tolist() for a, b in zip(first[:-1], first[1:])]
        begin = np.searchsorted(owner, np.arange(len(block) + 1))

        def reachable(k: int, found: np.ndarray) -> int:
            """Words of item ``k`` inside of windows that a document has; no tiling covers more."""
            hit = np.isin(windows[begin[k] : begin[k + 1]], found)
            step = np.zeros(len(of_item[k]) + 1, np.int64)
            start = np.flatnonzero(hit)
            np.add.at(step, start, 1)
            np.add.at(step, start + min_match, -1)
            return int((np.cumsum(step) > 0).sum())

        for batch in slices(batches):
            ids, out = batch.column("doc_id"), []
            w, f = plain_words(batch.column("text"))
            start, h = windows_of(w, f, min_match)
            may = coarse[h >> np.uint64(64 - FILTER_BITS)]
            start, h = start[may], h[may]
            left, right = np.searchsorted(seeds, h, "left"), np.searchsorted(seeds, h, "right")
            hit = right > left
            start, left, right = start[hit], left[hit], right[hit]
            h, n = h[hit], right - left
            doc = np.repeat(np.searchsorted(f, start, "right") - 1, n)
            item_no = owners[np.repeat(left - np.cumsum(n) + n, n) + np.arange(n.sum())]
            pair = doc * max(len(block), 1) + item_no
            by = np.argsort(pair, kind="stable")
            cuts = np.flatnonzero(np.diff(pair[by])) + 1
            seen, place = np.repeat(h, n)[by], np.repeat(start, n)[by]
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(by)]) if len(by) else ():
                d, k = divmod(int(pair[by[a]]), max(len(block), 1))
                item = of_item[k]
                if reachable(k, seen[a:b]) < threshold * len(item):
                    continue
                starts = place[a:b].tolist()
                # Only words inside seeds can be in a match; a gap becomes a word that no item has.
                region: list[int] = []
                end = -1
                for s in starts:
                    if end >= 0 and s > end:
                        region.append(-1 & 0xFFFFFFFFFFFFFFFF)
                    region += w[max(s, end) : s + min_match].tolist()
                    end = s + min_match
                tiles = tile(item, region, min_match)
                n = sum(t[2] for t in tiles)
                if n >= threshold * len(item):
                    out.append((ids[d].as_py(), block[k][0], n / len(item), len(tiles), n, len(item)))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32())
                names = [c.split()[0] for c in SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    return run


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    min_match: int = MIN_MATCH,
    threshold: float = THRESHOLD,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row for each document and item whose coverage reaches ``threshold``; other documents have none.

    Null and empty texts share nothing.  Items of fewer than ``min_match`` words cannot be told from chance
    and are skipped.  A row that repeats is reported as often as it stands in ``docs`` (or ``items``).
    """
    found = [
        docs.select("doc_id", "text").mapInArrow(_searcher(block, min_match, threshold), SCHEMA)
        for block in _blocks(items, block_bytes)
    ]
    if not found:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    return reduce(DataFrame.unionByName, found)


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, that no item contaminates; rows without a ``doc_id`` stay, and of
    rows that share one all go if one is contaminated."""
    return without(docs, contaminated(docs, items, **options))


def coverage_by_item(found: DataFrame) -> DataFrame:
    """How many documents each benchmark item leaked into, and its greatest coverage."""
    return found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_docs"), F.max("coverage").alias("coverage"))
