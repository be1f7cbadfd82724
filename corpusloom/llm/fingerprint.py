"""Document fingerprints by locally consistent parsing.

A text is a sequence of code points.  On every level runs of an equal symbol become one symbol, deterministic
coin tossing gives every symbol a label from itself and its left neighbour (the place and value of the lowest
bit in which they differ, applied until labels are below six), and phrases end before local maxima of the
labels.  The name of a phrase is a hash of its symbols, and the names are the next level's sequence.  Where a
phrase ends depends on a few symbols around it, so equal substrings get equal phrases, but for some at their
ends, wherever they stand.

The fingerprint holds, for three neighbouring levels, the smallest ``KEEP`` hashes of the level's names, each
numbered by its occurrence so that repeated phrases weigh; the middle one is the highest level with at least
``ENOUGH`` phrases.  Likeness is the Jaccard similarity (of multisets), estimated from the smallest hashes, at
the highest level that both fingerprints hold with enough names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import ROLL, mix, running, slices, window_hash

KEEP = 32
ENOUGH = 16
LEVELS = 24
# Code points parsed together; eight-byte values are held for each.
SLICE = 500_000
# Documents per block of neighbours, and the most blocks.
BLOCK_DOCS, MAX_BLOCKS = 1024, 1_000_000
OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _toss(x: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Twice the place of the lowest bit in which ``x`` and ``left`` differ, plus that bit of ``x``."""
    differ = x ^ left
    low = differ & (~differ + x.dtype.type(1))
    place = np.frexp(low.astype(np.float64))[1].astype(np.uint8) - np.uint8(1)
    # Equal neighbours (two hashes that clash) have no such bit and get the last label.
    return np.minimum((place << np.uint8(1)) | ((x & low) != 0), np.uint8(127))


# Labels below 128 and their left neighbours, looked up from the second toss on.
_AGAIN = np.array([[0 if a == b else 2 * (((a ^ b) & -(a ^ b)).bit_length() - 1) + bool(a & (a ^ b) & -(a ^ b)) for b in range(128)] for a in range(128)], np.uint8)


def _ends(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Marks the symbols that begin a phrase.  Neighbours within a document differ; every document begins one.

    The first symbol of a document is tossed against a fixed value, so nothing before it matters.
    """
    n = len(symbols)
    heads = first[:-1][np.diff(first) > 0]
    left = np.empty_like(symbols)
    left[1:] = symbols[:-1]
    left[heads] = ~symbols[heads]
    label = _toss(symbols, left)
    # 64 bits give labels below 128, then 14, then 8, then 6; six stays six.
    for _ in range(3):
        left = np.empty_like(label)
        left[1:] = label[:-1]
        left[heads] = label[heads] ^ 1
        label = _AGAIN[label, left]
    before, after = np.zeros(n, np.int8), np.zeros(n, np.int8)
    before[1:], after[:-1] = label[:-1], label[1:]
    here = label.astype(np.int8)
    tails = heads[1:] - 1
    before[heads], after[-1:], after[tails] = -1, -1, -1
    begin = (here > before) & (here >= after)
    # The symbol after the start of a document never begins a phrase of its own.
    begin[heads[heads + 1 < n] + 1] = False
    begin[heads] = True
    return begin


def parse(symbols: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Level by level the names of the phrases and where each document's begin, until all have one phrase."""
    for _ in range(LEVELS):
        if not len(symbols):
            return
        # Runs of one symbol become one, told apart by their length.
        fresh = np.ones(len(symbols), bool)
        fresh[1:] = symbols[1:] != symbols[:-1]
        fresh[first[:-1][np.diff(first) > 0]] = True
        at = np.flatnonzero(fresh)
        length = np.diff(np.r_[at, len(symbols)])
        base = symbols[at]
        several = length > 1
        base[several] = mix(base[several] * ROLL + length[several].astype(np.uint64))
        first = np.searchsorted(at, first)
        # Two runs that follow each other must differ; with hashes of 64 bits they do.
        begin = np.flatnonzero(_ends(base, first))
        stop = np.r_[begin[1:], len(base)]
        symbols = window_hash(running(base), begin, stop)
        first = np.searchsorted(begin, first)
        yield symbols, first
        if np.diff(first).max(initial=0) <= 1:
            return


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
    return mix((raw.astype(np.uint64) + np.uint64(1)) * ROLL), first


def _numbered(names: np.ndarray, at: np.ndarray, use: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of (name, its how-manyeth occurrence) of documents ``use``, smallest first, and where each's begin."""
    size = np.diff(at)[use]
    pick = np.repeat(at[use] - np.cumsum(size) + size, size) + np.arange(size.sum())
    doc = np.repeat(np.arange(len(use)), size)
    order = np.lexsort((names[pick], doc))
    name = names[pick][order]
    new = np.ones(len(name), bool)
    new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    times = np.arange(len(name)) - np.repeat(head, np.diff(np.r_[head, len(name)]))
    h = (mix(mix(name ^ np.uint64(level)) + times.astype(np.uint64) * ROLL) >> np.uint64(32)).astype(np.uint32)
    pair = np.unique(doc.astype(np.uint64) << np.uint64(32) | h)
    return pair.astype(np.uint32), np.searchsorted(pair >> np.uint64(32), np.arange(len(use) + 1).astype(np.uint64))


def sketches(texts: list[str]) -> list[dict[int, np.ndarray]]:
    """For every text the smallest ``KEEP`` hashes of its three levels; an empty text has none."""
    out: list[dict[int, np.ndarray]] = [{} for _ in texts]
    start = _code_points(texts)
    levels = [start, *parse(*start)]
    phrases = np.array([np.diff(at) for _, at in levels])
    # The highest level with enough phrases; code points, level 0, for the shortest texts.
    middle = np.maximum((phrases >= ENOUGH).sum(0) - 1, 0)
    for level, (names, at) in enumerate(levels):
        use = np.flatnonzero((np.abs(middle - level) <= 1) & (phrases[level] > 0))
        h, begin = _numbered(names, at, use, level)
        for d, a, b in zip(use.tolist(), begin[:-1].tolist(), begin[1:].tolist()):
            out[d][level] = h[a : min(b, a + KEEP)]
    return out


def written(sketch: dict[int, np.ndarray]) -> str:
    """A sketch as text: level, colon, hashes in hexadecimal; levels are joined by a slash."""
    return "/".join(f"{k}:{v.astype('>u4').tobytes().hex()}" for k, v in sorted(sketch.items()))


def likeness(a: dict[int, np.ndarray], b: dict[int, np.ndarray]) -> float:
    """Estimated Jaccard similarity of the phrase names, 0 to 1; two empty texts are alike."""
    if not a or not b:
        return float(not a and not b)
    common = sorted(set(a) & set(b), reverse=True)
    if not common:
        return 0.0
    level = next((k for k in common if min(len(a[k]), len(b[k])) >= ENOUGH), common[-1])
    x, y = a[level], b[level]
    # The smallest KEEP of the union; below that many names of each the sets are whole.
    union = np.union1d(x, y)[:KEEP] if max(len(x), len(y)) == KEEP else np.union1d(x, y)
    return float(np.isin(union, np.intersect1d(x, y)).sum() / len(union))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row; a null text is empty and has the empty fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, limit=SLICE):
            prints = [written(s) for s in sketches([t or "" for t in piece.column("text").to_pylist()])]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


def _block_starts(docs: DataFrame, block_docs: int) -> tuple[np.ndarray, int | None]:
    """Some of the ``doc_id``, chosen by hash, that cut the order into blocks, and the greatest id.

    About one in ``block_docs`` is chosen, or fewer so that they stay near MAX_BLOCKS at any size.
    """
    n, top = docs.agg(F.count("doc_id"), F.max("doc_id")).first()
    every = max(block_docs, -(-n // MAX_BLOCKS))
    chosen = docs.where(F.col("doc_id").isNotNull() & (F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)).select("doc_id").distinct().toPandas()
    return np.sort(chosen["doc_id"].to_numpy(np.int64)), top


def _dealer(cuts: np.ndarray, top: int | None):
    """Sends a row to the block of its id and, where it may be the next document of another block, there too.

    Block k holds the ids above cuts[k - 1] up to cuts[k], so the document after its last one in falling
    order is cuts[k - 1] itself; after the smallest of all comes the greatest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for piece in slices(batches):
            ids = piece.column("doc_id").to_pylist()
            block = [0 if i is None else int(np.searchsorted(cuts, i, "left")) for i in ids]
            body = [pack((t or "").encode()) for t in piece.column("text").to_pylist()]
            rows = [(b, False, i, x) for b, i, x in zip(block, ids, body)]
            at = np.searchsorted(cuts, [0 if i is None else i for i in ids])
            for k, (i, a) in enumerate(zip(ids, at.tolist())):
                if i is not None and a < len(cuts) and cuts[a] == i:
                    rows.append((a + 1, True, i, body[k]))
                if i is not None and i == top:
                    rows.append((0, True, i, body[k]))
            cols = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.bool_(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(cols, names=["block", "guest", "doc_id", "body"])

    return run


def _compare(table: pa.Table) -> pa.Table:
    unpack = zstandard.ZstdDecompressor().decompress
    rows = list(zip(*(table.column(c).to_pylist() for c in ("guest", "doc_id", "body"))))
    # Falling doc_id, rows without one last; equal ids in the order of their texts' bytes.
    keyed = [(i is None, -(i or 0), hashlib.sha256(unpack(b)).digest(), g, i, b) for g, i, b in rows]
    own = sorted(r for r in keyed if not r[3])
    guests = sorted(r for r in keyed if r[3])
    if not own:
        return _result([])
    below = [g for g in guests if not g[0] and (own[-1][0] or g[1] > own[-1][1])]
    above = [g for g in guests if g not in below]
    # The block of the smallest ids goes on with the greatest one; without any guest it is its own.
    chain = own + [(below or above or own)[0]]
    out = []
    width = 256
    for at in range(0, len(own), width):
        part = chain[at : at + width + 1]
        texts = [unpack(r[5]).decode() for r in part]
        edited = []
        for t, after in zip(texts, texts[1:]):
            n = len(t) // 3
            edited.append(t[: len(t) - n] + after[:n])
        a, b = _sketch_all(texts), _sketch_all(edited)
        for k, e in enumerate(edited):
            out.append((
                part[k][4], len(texts[k]), hashlib.sha256(e.encode()).hexdigest(), written(a[k]), written(b[k]), likeness(a[k], b[k]), likeness(a[k], a[k + 1]),
            ))
    return _result(out)


def _sketch_all(texts: list[str]) -> list[dict[int, np.ndarray]]:
    """Sketches in bounded pieces."""
    out: list[dict[int, np.ndarray]] = []
    piece, size = [], 0
    for t in texts:
        if piece and size + len(t) > SLICE:
            out += sketches(piece)
            piece, size = [], 0
        piece.append(t)
        size += len(t)
    return out + (sketches(piece) if piece else [])


def _result(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    cols = list(zip(*rows)) or [()] * len(kinds)
    return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names=[c.split()[0] for c in OUT.split(", ")])


def compare_with_next(docs: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next document's are.

    The next document is the one before in ``doc_id`` (after the smallest: the greatest).  The edited text is
    the text whose last third of code points gave way to the first as many of the next one.  A null text is
    empty; rows that share a ``doc_id`` follow each other in the order of their texts' SHA-256; rows without
    one come after all others.  A single document is its own next; an empty table gives an empty table.
    """
    cuts, top = _block_starts(docs, block_docs)
    dealt = docs.select("doc_id", "text").mapInArrow(_dealer(cuts, top), "block int, guest boolean, doc_id long, body binary")
    return dealt.groupBy("block").applyInArrow(_compare, OUT)
