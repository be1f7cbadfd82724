"""Best-fit packing by the sum-of-squares rule.

A sequence holds at most ``capacity`` tokens.  Pieces are taken from long to short; each goes to the open
sequence after which the sum over all residual gaps g of N(g)**2 is smallest, N(g) being the number of
open sequences with that gap, and to a new sequence where no open one has room.  Many equal gaps are dear,
so gaps of all sizes are kept in supply and few sequences are left open at the end.

The rule is sequential, so pieces are dealt by hash into pools of about ``pool_rows`` pieces and each pool
is packed by itself.  What a pool leaves in sequences with more than ``slack`` free tokens is dealt again
into (far fewer) pools and packed once more.  No piece is dropped and none is moved after that.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import materialize, slices

CAPACITY = 2048
POOL_ROWS = 20_000
SLACK = 32
END_OF_TEXT = 0
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Ids of whole texts for a byte-level tokenizer file of the ``tokenizers`` library.

    The vocabulary is read from that file and run by ``tiktoken``, which gives the same ids about four times
    as fast.  Texts that hold the string of a special token go to ``tokenizers`` itself.
    """

    # Fixed value: the pre-token pattern that byte-level tokenizer files stand for.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        self.special = [t["content"] for t in spec["added_tokens"]]
        # The files write bytes as printable characters: printable ones as themselves, the rest from 256 on.
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        byte_of = {chr(b): b for b in plain}
        byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
        self.ranks = {bytes(byte_of[c] for c in token): k for token, k in spec["model"]["vocab"].items() if token not in self.special}
        self.encode = tiktoken.Encoding("ids", pat_str=self.PATTERN, mergeable_ranks=self.ranks, special_tokens={}).encode_ordinary

    @cached_property
    def tokenizer(self):
        """The ``tokenizers`` library's own reading of the file, loaded when a text first needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def ids(self, text: str) -> list[int]:
        if any(s in text for s in self.special):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.encode(text)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces: only the first of several may be shorter than ``capacity``."""
    first = length % capacity or min(length, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece with the checksum of its ids (little-endian unsigned 32-bit).

    Every document ends with id 0; a null or empty text is that id alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in slices(batches):
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array([*enc.ids(text or ""), END_OF_TEXT], "<u4")
                for k, (s, n) in enumerate(cut(len(ids), capacity)):
                    out.append((doc, k, s, n, zlib.crc32(ids[s : s + n].tobytes())))
            cols = list(zip(*out))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ("doc_id", "piece", "start", "length", "ids_crc32")
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=list(names))

    return docs.select("doc_id", "text").mapInArrow(run, PIECE_SCHEMA)


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) for pieces in the given order; ties go to the smallest remaining gap."""
    twice = np.zeros(capacity + 1, np.int64)  # 2 * N(gap); an entry of -1 for gap 0 makes closing free
    twice[0] = -1
    bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    where, at, opened = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    far = np.iinfo(np.int64).max
    for i, s in enumerate(lengths.tolist()):
        gap = 0
        if s < capacity:
            now = twice[s:capacity]
            cost = np.where(now > 0, twice[: capacity - s] - now + 2, far)
            best = int(cost.argmin())
            gap = best + s if cost[best] < far else 0
        if gap:
            b = bins[gap].pop()
            twice[gap] -= 2
        else:
            b, gap, opened = opened, capacity, opened + 1
        where[i], at[i] = b, capacity - gap
        if gap > s:
            bins[gap - s].append(b)
            twice[gap - s] += 2
    return where, at


def _pool_packer(capacity: int, base: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # Long pieces first; equal lengths in a fixed order, so that a task run again gives the same.
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        where, at = sum_of_squares(rows["length"].to_numpy(), capacity)
        fill = np.bincount(where, weights=rows["length"].to_numpy()).astype(np.int64)
        first = (base + int(rows["pool"].iloc[0])) << 32
        return rows.assign(sequence_id=where + first, offset=at, fill=fill[where])

    return run


def pack(df: DataFrame, n_rows: int, capacity: int = CAPACITY, pool_rows: int = POOL_ROWS, slack: int = SLACK) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (rows of ``PIECE_SCHEMA``); ``n_rows`` sizes the pools.

    Rows that repeat are packed like any other; an empty table gives an empty table.
    """
    schema = f"{PIECE_SCHEMA}, pool int, sequence_id long, offset long, fill long"

    def deal(rows: DataFrame, pools: int, base: int) -> DataFrame:
        pool = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(base)), F.lit(pools)).cast("int")
        return rows.withColumn("pool", pool).groupBy("pool").applyInPandas(_pool_packer(capacity, base), schema)

    pools = max(1, -(-n_rows // pool_rows))
    done = materialize(deal(df, pools, 0), "packed")
    loose = F.col("fill") < capacity - slack
    left = done.where(loose)
    n_left = left.count()
    columns = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]
    again = deal(left.select(*columns), max(1, -(-n_left // pool_rows)), pools)
    return done.where(~loose).unionByName(again).select(*columns, "sequence_id", "offset")


def best_fit_pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    pool_rows: int = POOL_ROWS,
    slack: int = SLACK,
) -> DataFrame:
    """Pack the ids of all documents (``doc_id``, ``text``) into sequences of at most ``capacity`` tokens.

    Null and empty texts are one token long, texts above ``capacity`` are cut, a null ``doc_id`` is kept,
    extra columns are ignored.
    """
    return pack(pieces(docs, tokenizer, capacity), docs.count(), capacity, pool_rows, slack)
