"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad.  Its features (shares of kinds of characters and words, each cut into bins) and those
of the lines before and after it make the line's potential; a two by two table weighs neighbouring labels.  Lines
of a labelled document carry its label.  Forward-backward gives every line's probability of being good; their
mean, weighted by length, is turned into the document's probability by a logistic curve.

Training documents are those whose crc32 remainder is not ``HELD_OUT``, copies once, about ``max_docs`` of them
at most, chosen by hash.  Their binned lines are written once; each step of the fit (L-BFGS) is a job that sums
the likelihood's gradient over them, so that only vectors as long as the weights reach the driver.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import ROLL, materialize, mix, random_table, running, slices, utf8, window_hash, word_bounds
from corpusloom.llm.toxicity import held_out, logistic, training_labels

MAX_DOCS = 20_000
CUTOFF = 0.5
RIDGE = 1.0
MAX_STEPS = 40
FEATURES = (
    "characters", "words", "word_length", "upper", "digits", "stops", "symbols", "exclamations",
    "decorated", "distinct", "repeated", "closed", "opened", "copied", "single",
)
BINS = 16
# Weights: a bin of every feature for the line itself, the one before and the one after it (one bin more where
# there is none), then the four pairs of labels, bad to bad, bad to good, good to bad, good to good.
SIDE = len(FEATURES) * (BINS + 1)
N_WEIGHTS = 3 * SIDE + 4

# Kinds of bytes; lead bytes of longer characters count as lower-case letters.
_BYTE = np.arange(256)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LETTER = _UPPER | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 0xC2)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_STOP = np.isin(_BYTE, list(b".,;:?"))
_CLOSE = np.isin(_BYTE, list(b".?:;\"')"))
_SPACE = np.isin(_BYTE, [0x20, 9, 10, 11, 12, 13])
_LATER = (_BYTE >= 0x80) & (_BYTE <= 0xBF)
_SYMBOL = ~(_LETTER | _DIGIT | _STOP | _CLOSE | _SPACE | _LATER)
_END = _LETTER | _LATER | _DIGIT | _STOP | _CLOSE


def bins_of(share: np.ndarray) -> np.ndarray:
    """Shares from 0 to 1: none, then fifteen equal steps."""
    return np.where(share > 0, 1 + np.minimum((share * (BINS - 1)).astype(np.int64), BINS - 2), 0)


def log_bins(n: np.ndarray) -> np.ndarray:
    """0, 1, then doubling steps."""
    return np.minimum(np.ceil(np.log2(n + 1)).astype(np.int64), BINS - 1)


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bins of every line, its weight in characters, number of lines before each text and one entry more).

    Lines are parted by line feeds; an empty or null text is one empty line.  An empty line weighs as one character.
    """
    raw, offsets = utf8(pc.binary_join_element_wise(pc.fill_null(texts, ""), "", "\n"))
    ends = np.flatnonzero(raw == 10)
    begins = np.r_[0, ends[:-1] + 1]
    first = np.searchsorted(ends, offsets)
    n = len(ends)
    if not n:
        return np.empty((0, len(FEATURES)), np.uint8), np.empty(0, np.int64), first

    def count(kind: np.ndarray) -> np.ndarray:
        return np.add.reduceat(kind[raw], begins, dtype=np.int64)

    chars = ends - begins - count(_LATER)
    letters = np.maximum(count(_LETTER), 1)
    some = np.maximum(chars, 1)
    starts, stops, _ = word_bounds(raw, offsets)
    line = np.searchsorted(ends, starts)
    words = np.bincount(line, minlength=n)
    many = np.maximum(words, 1)
    run = running(random_table(1)[raw])
    name = window_hash(run, starts, stops)
    # The line above 40 bits of the word: sorted, equal words of a line stand together.
    key = np.sort(line.astype(np.uint64) << np.uint64(40) | name >> np.uint64(24))
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[fresh] >> np.uint64(40)).astype(np.int64), minlength=n)
    again = np.zeros(len(name), bool)
    again[1:] = (name[1:] == name[:-1]) & (line[1:] == line[:-1])

    def share(of_words: np.ndarray) -> np.ndarray:
        return bins_of(np.bincount(line[of_words], minlength=n) / many)

    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole = mix(window_hash(run, begins, ends) + doc.astype(np.uint64) * ROLL)
    order = np.argsort(whole, kind="stable")
    copied = np.zeros(n, bool)
    copied[order[1:]] = whole[order[1:]] == whole[order[:-1]]
    last = np.flatnonzero(np.r_[line[1:] != line[:-1], True]) if len(line) else line
    front = np.flatnonzero(np.r_[True, line[1:] != line[:-1]]) if len(line) else line
    closed, opened = np.full(n, 2), np.full(n, 2)
    closed[line[last]] = _CLOSE[raw[stops[last] - 1]]
    opened[line[front]] = _UPPER[raw[starts[front]]] | (raw[starts[front]] >= 0xC2)
    columns = (
        log_bins(chars), log_bins(words), np.minimum(chars // many, BINS - 1), bins_of(count(_UPPER) / letters), bins_of(count(_DIGIT) / some),
        bins_of(np.minimum(count(_STOP) / many, 1)), bins_of(count(_SYMBOL) / some), bins_of(np.minimum(count(_BYTE == 33) / many, 1)),
        share(~_END[raw[stops - 1]]), bins_of(distinct / many), share(again), closed, opened, (copied & (words > 0)).astype(np.int64), share(stops - starts == 1),
    )
    return np.stack(columns, 1).astype(np.uint8), np.maximum(chars, 1), first


def potentials(bins: np.ndarray, first: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Log-odds of good for every line by itself, and the weights' numbers that each side adds up."""
    at = bins.astype(np.int64) + np.arange(len(FEATURES)) * (BINS + 1)
    none = np.arange(len(FEATURES)) * (BINS + 1) + BINS
    before, after = np.roll(at, 1, 0), np.roll(at, -1, 0)
    before[first[:-1]] = none
    after[first[1:] - 1] = none
    sides = [at, before + SIDE, after + 2 * SIDE]
    return sum(weights[x].sum(1) for x in sides), sides


def forward_backward(odds: np.ndarray, first: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """(probability of good for every line, sum of log Z over texts, expected numbers of neighbouring labels).

    Texts go through the lattice together, long ones first, one line of each at a time.
    """
    n = len(odds)
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    start, length = first[:-1][order], size[order]
    good = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
    own = np.stack([1 - good, good], 1) + 1e-300
    top = pairs.max()
    move = np.exp(pairs - top)
    ahead, scale = np.empty((n, 2)), np.empty(n)
    active = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), "left")  # texts longer than t
    for t, m in enumerate(active):
        at = start[:m] + t
        now = own[at] if t == 0 else (ahead[at - 1] @ move) * own[at]
        scale[at] = now.sum(1)
        ahead[at] = now / scale[at, None]
    back = np.ones((n, 2))
    expected = np.zeros((2, 2))
    for t in range(len(active) - 1, 0, -1):
        at = start[: active[t]] + t
        tail = own[at] * back[at] / scale[at, None]
        back[at - 1] = tail @ move.T
        expected += ahead[at - 1].T @ tail
    both = ahead * back
    log_z = np.log(scale).sum() + np.logaddexp(0, odds).sum() + top * (n - len(size))
    return both[:, 1] / both.sum(1), float(log_z), expected * move


def loss_of(bins: np.ndarray, first: np.ndarray, label: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray]:
    """Minus the log-likelihood of texts whose lines all carry the text's label, and its gradient."""
    odds, sides = potentials(bins, first, weights)
    pairs = weights[3 * SIDE :].reshape(2, 2)
    good, log_z, expected = forward_backward(odds, first, pairs)
    size = np.diff(first)
    y = np.repeat(label, size)
    seen = np.zeros((2, 2))
    for k in (0, 1):
        seen[k, k] = (size[label == k] - 1).sum()
    gradient = np.zeros(N_WEIGHTS)
    for x in sides:
        gradient += np.bincount(x.ravel(), np.repeat(good - y, x.shape[1]), N_WEIGHTS)
    gradient[3 * SIDE :] = (expected - seen).ravel()
    return log_z - float((odds * y).sum() + (pairs * seen).sum()), gradient


def minimize(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int = MAX_STEPS, memory: int = 8) -> np.ndarray:
    """L-BFGS with halving of steps that do not lower the loss enough."""
    value, g = loss(x)
    kept: deque = deque(maxlen=memory)
    for _ in range(steps):
        q = g.copy()
        used = []
        for s, y, r in reversed(kept):
            a = r * (s @ q)
            q -= a * y
            used.append(a)
        q *= (kept[-1][0] @ kept[-1][1]) / (kept[-1][1] @ kept[-1][1]) if kept else 1 / max(np.linalg.norm(g), 1e-12)
        for (s, y, r), a in zip(kept, reversed(used)):
            q += s * (a - r * (y @ q))
        slope, step = float(g @ q), 1.0
        for _ in range(20):
            new = x - step * q
            new_value, new_g = loss(new)
            if new_value <= value - 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, y = new - x, new_g - g
        if s @ y > 1e-12:
            kept.append((s, y, 1 / (s @ y)))
        done = value - new_value < 1e-4 * max(abs(value), 1.0)
        x, value, g = new, new_value, new_g
        if done:
            break
    return x


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    intercept: float
    slope: float


def _binner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Binned lines of training documents, one row per document."""
    for piece in slices(batches):
        bins, weight, first = line_features(piece.column("text"))
        cut = list(zip(first[:-1], first[1:]))
        cols = [piece.column("quality"), pa.array([bins[a:b].tobytes() for a, b in cut]), pa.array([weight[a:b].astype(np.int64).tobytes() for a, b in cut])]
        yield pa.RecordBatch.from_arrays(cols, names=["quality", "bins", "weights"])


def _unbinned(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rows = [np.frombuffer(x, np.uint8).reshape(-1, len(FEATURES)) for x in batch.column("bins").to_pylist()]
    weight = np.frombuffer(b"".join(batch.column("weights").to_pylist()), np.int64)
    first = np.cumsum([0, *(len(x) for x in rows)])
    return np.concatenate(rows), weight, first, np.asarray(batch.column("quality")).astype(np.int64)


def _gradient(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, value = np.zeros(N_WEIGHTS), 0.0
        for batch in batches:
            if len(batch):
                bins, _, first, label = _unbinned(batch)
                v, g = loss_of(bins, first, label, weights)
                value, total = value + v, total + g
        yield pa.RecordBatch.from_arrays([pa.array([value]), pa.array([total.tobytes()])], names=["loss", "gradient"])

    return run


def document_odds(bins: np.ndarray, weight: np.ndarray, first: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log-odds of each text's length-weighted share of good lines, kept within 12 of zero; the lines' marginals)."""
    odds, _ = potentials(bins, first, weights)
    good, _, _ = forward_backward(odds, first, weights[3 * SIDE :].reshape(2, 2))
    mean = np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1]) if len(first) > 1 else np.empty(0)
    return np.clip(np.log(mean + 1e-9) - np.log(1 - mean + 1e-9), -12, 12), good


def _curve_points(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                bins, weight, first, label = _unbinned(batch)
                x = np.round(document_odds(bins, weight, first, weights)[0], 1)
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(label)], names=["x", "label"])

    return run


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, ridge: float = RIDGE, steps: int = MAX_STEPS) -> Model:
    """Train on ``labels`` (``doc_id``, ``quality`` 0 or 1).  Without labels of both kinds every document gets the
    share of good labels, one half without any."""
    texts = docs.select("doc_id", "text")
    known = training_labels(texts, labels, max_docs, "quality").select("doc_id", "quality")
    rows = texts.join(F.broadcast(known), "doc_id").select("text", "quality")  # at most max_docs rows are broadcast
    rows = materialize(rows.mapInArrow(_binner, "quality int, bins binary, weights binary"), "lines")
    n = dict(rows.groupBy("quality").count().collect())
    bad, good = n.get(0, 0), n.get(1, 0)
    if not bad or not good:
        return Model(np.zeros(N_WEIGHTS), float(np.log((good + 1) / (bad + 1))), 0.0)

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        value, gradient = 0.5 * ridge * float(w @ w), ridge * w
        for r in rows.mapInArrow(_gradient(w), "loss double, gradient binary").collect():
            value, gradient = value + r["loss"], gradient + np.frombuffer(r["gradient"])
        return value, gradient

    weights = minimize(loss, np.zeros(N_WEIGHTS), steps)
    bins = rows.mapInArrow(_curve_points(weights), "x double, label long").groupBy("x").agg(F.sum("label").alias("g"), F.sum(1 - F.col("label")).alias("b"))
    x, g, b = (bins.toPandas()[c].to_numpy(float) for c in ("x", "g", "b"))
    return Model(weights, *logistic(x, g, b))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, n_lines, bad_lines) for every document; ``bad_lines`` are numbers, from 0, of lines that
    are more likely bad than good.

    A null or empty text is one empty line and is scored as such.  Rows that repeat are scored alike, a null
    ``doc_id`` stays, extra columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            bins, weight, first = line_features(piece.column("text"))
            x, good = document_odds(bins, weight, first, model.weights)
            p = 1 / (1 + np.exp(-(model.intercept + model.slope * x)))
            bad = [np.flatnonzero(good[a:b] < 0.5).tolist() for a, b in zip(first[:-1], first[1:])]
            cols = [piece.column("doc_id"), pa.array(p), pa.array(np.diff(first)), pa.array(bad, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "score", "n_lines", "bad_lines"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, n_lines long, bad_lines array<int>")


def judge(docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF, max_docs: int = MAX_DOCS) -> DataFrame:
    """Fit on ``labels`` and score all documents: doc_id, held_out, score, predicted, and the bad lines."""
    out = score(docs, fit(docs, labels, max_docs))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= cutoff).cast("int").alias("predicted"), "n_lines", "bad_lines")
