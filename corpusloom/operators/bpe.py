"""Byte-pair vocabularies: trained over the distinct pieces of a corpus, applied by merge rank.

Texts are cut into pieces (a word with its leading space, or one white space character), pieces into UTF-8
bytes.  Training merges the most frequent pair of neighbouring symbols over and over; equal counts go to the pair
whose newer symbol is older, then to the smaller left and right symbol.

One job counts all pairs of the distinct pieces and returns the best few.  Of these, those are merged together
that cannot influence each other: while no pair begins with the right symbol of an earlier one or ends with the left
symbol of one, its own count stays as it is, and every pair that the merges create is at most as frequent
as a pair that has not been reached.  So the merges are those of a trainer that counts anew after each of them.

Ids are those of ``tokens``: 0 ends a document, 1 to 256 are bytes, merges follow.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.tokens import EOD, FIRST_BYTE, FIRST_WORD, PIECE, pieces
from corpusloom.session import materialize, small_batches

# Best pairs that one job returns, and rounds after which the pieces are written as merged so far.
TOP_PAIRS, WRITE_EVERY = 512, 8
# Pieces that one worker remembers.
REMEMBERED = 200_000
STATE = "n long, symbols array<int>"
_SHIFT = np.int64(1 << 31)


def distinct_pieces(df: DataFrame, text: str = "text") -> DataFrame:
    """(n, symbols) of every different piece of all texts; null texts have none."""
    counted = df.select(F.explode(pieces(F.col(text))).alias("_p")).groupBy("_p").agg(F.count("*").alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            symbols = [[FIRST_BYTE + x for x in p.encode()] for p in b.column("_p").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("n"), pa.array(symbols, pa.list_(pa.int32()))], names=["n", "symbols"])

    return counted.mapInArrow(run, STATE)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, symbols in a row, and the piece of each symbol."""
    lists = batch.column("symbols")
    size = np.diff(lists.offsets.to_numpy())
    return batch.column("n").to_numpy(), lists.flatten().to_numpy().astype(np.int64), np.repeat(np.arange(len(size)), size)


def merge_pairs(symbols: np.ndarray, owner: np.ndarray, merges: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and their pieces after (left, right, new) merges that do not share places; runs merge from the left."""
    if len(symbols) < 2:
        return symbols, owner
    codes = np.array([a * int(_SHIFT) + b for a, b, _ in merges], np.int64)
    order = np.argsort(codes)
    codes, new = codes[order], np.array([c for *_, c in merges], np.int64)[order]
    pair = symbols[:-1] * _SHIFT + symbols[1:]
    at = np.minimum(np.searchsorted(codes, pair), len(codes) - 1)
    hit = (codes[at] == pair) & (owner[1:] == owner[:-1])
    # In a run of one symbol, every second place of its stretch of hits is taken.
    place = np.arange(len(hit))
    begin = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], place, 0))
    taken = hit & ((place - begin) % 2 == 0)
    out = symbols.copy()
    out[:-1][taken] = new[at[taken]]
    keep = np.r_[True, ~taken]
    return out[keep], owner[keep]


def _merged(rounds: list[list[tuple[int, int, int]]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, symbols, owner = _flat(batch)
            for merges in rounds:
                symbols, owner = merge_pairs(symbols, owner, merges)
            offsets = np.searchsorted(owner, np.arange(len(n) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(symbols.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array(n), lists], names=["n", "symbols"])

    return run


def _pair_counts(rounds: list[list[tuple[int, int, int]]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _merged(rounds)(batches):
            n, symbols, owner = _flat(batch)
            same = owner[1:] == owner[:-1]
            pair, at = np.unique(symbols[:-1][same] * _SHIFT + symbols[1:][same], return_inverse=True)
            count = np.zeros(len(pair), np.int64)
            np.add.at(count, at, n[owner[1:][same]])
            cols = [pa.array((pair // _SHIFT).astype(np.int32)), pa.array((pair % _SHIFT).astype(np.int32)), pa.array(count)]
            yield pa.RecordBatch.from_arrays(cols, names=["a", "b", "count"])

    return run


def independent(pairs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The longest start of (left, right, count) pairs, best first, that can be merged together."""
    out: list[tuple[int, int, int]] = []
    lefts: set[int] = set()
    rights: set[int] = set()
    for a, b, n in pairs:
        if a in rights or b in lefts:
            break
        out.append((a, b, n))
        if a == b:  # how often the new symbol meets itself is not bounded by any pair behind
            break
        lefts.add(a)
        rights.add(b)
    return out


def train(df: DataFrame, n_merges: int, text: str = "text", min_count: int = 2, top: int = TOP_PAIRS, write_every: int = WRITE_EVERY) -> DataFrame:
    """(rank, left, right, id, n): up to ``n_merges`` merges, best first, of pairs met at least ``min_count`` times.

    A piece counts as often as it stands in the corpus; pairs never reach over the edge of a piece.  Only the best
    ``top`` pairs of a round reach the driver, and the merges themselves, as many as the caller asks for.
    """
    spark = df.sparkSession
    state = materialize(distinct_pieces(df, text), "pieces")
    merges: list[tuple[int, int, int, int, int]] = []
    rounds: list[list[tuple[int, int, int]]] = []
    while len(merges) < n_merges:
        if len(rounds) == write_every:
            state, rounds = materialize(state.mapInArrow(_merged(rounds), STATE), "pieces"), []
        counts = state.mapInArrow(_pair_counts(rounds), "a int, b int, count long").groupBy("a", "b").agg(F.sum("count").alias("n"))
        best = counts.where(F.col("n") >= min_count).orderBy(F.desc("n"), F.greatest("a", "b"), "a", "b").limit(top)
        chosen = independent([(r["a"], r["b"], r["n"]) for r in best.collect()])[: n_merges - len(merges)]
        if not chosen:
            break
        first = FIRST_WORD + len(merges)
        rounds.append([(a, b, first + k) for k, (a, b, _) in enumerate(chosen)])
        merges += [(len(merges) + k, a, b, first + k, n) for k, (a, b, n) in enumerate(chosen)]
    return spark.createDataFrame(merges, "rank int, left int, right int, id int, n long")


def symbol_bytes(merges: list[tuple[int, int, int]]) -> dict[int, bytes]:
    """The bytes of every id, from (left, right, id) by rank; the end of a document has none."""
    out = {EOD: b""} | {FIRST_BYTE + k: bytes([k]) for k in range(256)}
    for a, b, c in merges:
        out[c] = out[a] + out[b]
    return out


class Encoder:
    """Ids of texts by merge rank."""

    def __init__(self, merges: list[tuple[int, int, int]]):
        self.rank = {(a, b): (k, c) for k, (a, b, c) in enumerate(merges)}
        self.pieces = regex.compile(PIECE).findall
        self.ids_of = lru_cache(REMEMBERED)(self._ids_of)

    def _ids_of(self, piece: str) -> tuple[int, ...]:
        """The pair of lowest rank is merged first, the leftmost of several; time grows as n log n."""
        ids = [FIRST_BYTE + x for x in piece.encode()]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r[0], i, r[1], ids[i], ids[i + 1]) for i in range(n - 1) if (r := self.rank.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, c, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one side has been merged since
            ids[i], ids[j] = c, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if r := self.rank.get((c, ids[after[i]])):
                    heapq.heappush(heap, (r[0], i, r[1], c, ids[after[i]]))
            if before[i] >= 0 and (r := self.rank.get((ids[before[i]], c))):
                heapq.heappush(heap, (r[0], before[i], r[1], ids[before[i]], c))
        return tuple(x for x in ids if x >= 0)

    def ids(self, text: str) -> list[int]:
        return [k for p in self.pieces(text) for k in self.ids_of(p)]


def merge_list(merges: DataFrame) -> list[tuple[int, int, int]]:
    """(left, right, id) by rank; as many as the vocabulary has merges."""
    return [(r["left"], r["right"], r["id"]) for r in merges.select("rank", "left", "right", "id").orderBy("rank").collect()]


def tokenize(df: DataFrame, merges: DataFrame, doc: str = "doc_id", text: str = "text", append_eod: bool = True) -> DataFrame:
    """(doc, tokens, n_tokens); a text without characters has no tokens and no end of document, null has null."""
    small_batches(df.sparkSession)
    known = merge_list(merges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(known)
        for b in batches:
            end = [EOD] if append_eod else []
            ids = [None if t is None else enc.ids(t) + end if t else [] for t in b.column(text).to_pylist()]
            cols = [b.column(doc), pa.array(ids, pa.list_(pa.int32())), pa.array([None if x is None else len(x) for x in ids], pa.int32())]
            yield pa.RecordBatch.from_arrays(cols, names=[doc, "tokens", "n_tokens"])
        enc.ids_of.cache_clear()  # the worker goes on to other tasks

    kind = df.schema[doc].dataType.simpleString()
    return df.select(doc, text).mapInArrow(run, f"`{doc}` {kind}, tokens array<int>, n_tokens int")


def detokenize(tokens: DataFrame, merges: DataFrame, doc: str = "doc_id", column: str = "tokens") -> DataFrame:
    """(doc, text): the texts back from their ids; ids outside of the vocabulary are an error."""
    small_batches(tokens.sparkSession)
    of = symbol_bytes(merge_list(merges))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if x is None else b"".join([of[k] for k in x]).decode() for x in b.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(doc), pa.array(texts, pa.string())], names=[doc, "text"])

    kind = tokens.schema[doc].dataType.simpleString()
    return tokens.select(doc, column).mapInArrow(run, f"`{doc}` {kind}, text string")
