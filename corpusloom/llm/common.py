"""Shared pieces of the operators: table access, bounded Arrow slices, and vectorised word hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import materialize, small_batches  # noqa: F401

# Text bytes that one slice of an Arrow batch holds at most (a single longer text is a slice of its own).
SLICE_BYTES = 1_000_000
# Fixed odd multipliers and seeds of the hash functions below.
ROLL = np.uint64(0x9E3779B97F4A7C15)
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Ids that may travel to every task.
MAX_BROADCAST_IDS = 500_000


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` is not in ``ids``; rows without a ``doc_id`` stay.

    The list is written and counted: up to MAX_BROADCAST_IDS it travels to the texts, beyond both are shuffled.
    """
    ids = materialize(ids.select("doc_id").distinct(), "ids")
    small = ids.count() <= MAX_BROADCAST_IDS
    return docs.join(F.broadcast(ids) if small else ids, "doc_id", "left_anti").select(*docs.columns)


def text_stats(docs: DataFrame) -> tuple[int, int]:
    """(rows, UTF-8 bytes of all texts); they set the number of parts, never which rows are used."""
    n, b = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    return int(n), int(b or 0)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches, without copying, so that a piece holds at most ``limit`` text bytes or one row."""
    for batch in batches:
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64()))
        end = np.cumsum(size)
        start = 0
        while start < batch.num_rows:
            before = end[start] - size[start]
            stop = max(start + 1, int(np.searchsorted(end, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins (one more entry than texts); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def random_table(seed: int) -> np.ndarray:
    """256 fixed random 64-bit values, one for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * ROLL + np.uint64(seed) * MIX_B)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = int(ROLL)) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (at least), kept per worker."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            pair.append(np.multiply.accumulate(steps))
        _POWERS[base] = (pair[0], pair[1])
    return _POWERS[base]


def running(values: np.ndarray, base: int = int(ROLL)) -> np.ndarray:
    """R with R[j] = sum of values[i] * base**i over i < j; any window's hash follows from two entries."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values) + 1, base)[0][: len(values)], out=out[1:])
    return out


def window_hash(run: np.ndarray, start: np.ndarray, stop: np.ndarray, base: int = int(ROLL)) -> np.ndarray:
    """Hash of the values in [start, stop), the same wherever they stand."""
    return mix((run[stop] - run[start]) * powers(len(run) + 1, base)[1][start])


# Byte values that part words: space and the five controls from tab to carriage return.
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each text the number of words before it (n + 1 entries).

    A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return.
    """
    inside = ~_IS_SPACE[raw]
    begins = np.empty(len(raw) + 1, bool)
    begins[0] = False
    begins[1:] = inside
    ends = begins.copy()
    first = inside.copy()
    cut = offsets[:-1][(offsets[:-1] < len(raw))]
    # A word starts where the byte before is white space or belongs to another text.
    before = begins[:-1].copy()
    before[cut] = False
    first &= ~before
    after = np.zeros(len(raw), bool)
    after[:-1] = inside[1:]
    after[cut[cut > 0] - 1] = False
    last = ends[1:] & ~after
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, stops, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, offsets: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and for each text the number of words before it (n + 1 entries)."""
    starts, stops, first = word_bounds(raw, offsets)
    return window_hash(running(random_table(seed)[raw]), starts, stops), first


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words (runs of letters and digits) of all texts, and where each text's begin."""
    plain = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\p{L}\p{N}]+", " ")
    return word_hashes(*utf8(plain))
