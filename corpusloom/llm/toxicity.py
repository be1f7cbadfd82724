"""Toxic passages as maximum-scoring segments of word log-odds.

A word's score is the log of its odds between toxic and clean training documents.  The counts (documents that
contain the word) have a Dirichlet prior in proportion to the word's count in the whole corpus, and the log-odds
are drawn towards zero by ``SHRINK`` standard errors and lowered by a drift, so that ordinary words score
below zero.  Of ``DRIFTS`` the one is taken whose scores tell the training documents apart best.  One linear scan over a text finds all its maximal scoring segments.  How often clean text holds a
segment of score S by chance, K * n * exp(-lambda * S) times in n words, is fitted to clean training documents;
a document's evidence is the sum of log(1 + 1 / expected) over its segments, and a logistic curve through the
training documents makes it a probability.

Models for the fit are crossed: a training document is scored by a model of the other fold.  Copies of one text
count once.  Only labelled
rows whose crc32 remainder is not ``HELD_OUT`` are learned from, about ``max_labels`` of them at most (chosen by
hash); word counts of the prior cover all documents.  Candidate words are those in at least ``MIN_DOCS`` toxic
training documents; they travel to the tasks that count them in all documents, and the words of ``max_labels``
documents bound their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import materialize, plain_words, slices

FOLDS, HELD_OUT = 3, 1
MAX_LABELS = 200_000
MIN_DOCS = 3
SHRINK, TOP = 1.64, 8.0
DRIFTS = (1.0, 1.5, 2.0, 2.5)
# The prior weighs this share of the training words.
PRIOR = 0.1
CUTOFF = 0.7


@dataclass(frozen=True)
class Words:
    """Log-odds, drawn towards zero, of the words whose log-odds exceed the smallest drift."""

    hashes: np.ndarray
    odds: np.ndarray

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of known words in an array of hashes, and their log-odds."""
        if not len(self.hashes):
            return np.empty(0, np.int64), np.empty(0)
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == words)
        return hit, self.odds[at[hit]]


@dataclass(frozen=True)
class Model:
    words: Words
    drift: float
    k: float
    lam: float
    intercept: float
    slope: float


def segments(places: list[int], scores: list[float], drift: float = DRIFTS[0]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score) of a text in which the words at ``places``
    have the given positive ``scores`` and every other word scores ``-drift``.

    Each positive word starts as a segment of its own.  Going left over the kept segments, the nearest one
    whose left sum is smaller takes it in, with all between, if that raises the right sum.  Every kept segment
    is linked to its nearest one with a smaller left sum, as Ruzzo and Tompa do, so each is passed over once.
    """
    kept: list[tuple[int, int, float, float, int]] = []  # first, last, sum before it, sum after it, link
    total, seen = 0.0, 0
    for p, s in zip(places, scores):
        total -= drift * (p - seen)
        seen = p + 1
        first, last, left, right = p, p, total, total + s
        total = right
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= left:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= right:
                kept.append((first, last, left, right, j))
                break
            first, _, left, _, link = kept[j]
            del kept[j:]
            j = link
    return [(a, b, r - lo) for a, b, lo, r, _ in kept]


def held_out(doc_id: Column | str) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def training_labels(docs: DataFrame, labels: DataFrame, max_labels: int, label: str = "toxic") -> DataFrame:
    """(doc_id, label, fold) of the rows that may be learned from; about ``max_labels`` rows at most, and one
    for documents with the same text."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out("doc_id"))
    rows = rows.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias(label))
    n = rows.count()
    if n > max_labels:
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * max_labels / n))
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    once = docs.join(F.broadcast(rows), "doc_id").groupBy(text.alias("_t")).agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    rows = rows.join(once, "doc_id", "left_semi")
    # Texts of one fold are never split from their copies, of which only one is left.
    return materialize(rows.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(2)).cast("int")), "labels")


LABELLED = "word long, toxic0 long, toxic1 long, clean0 long, clean1 long"
# The word that stands for all words; no word has this hash.
ALL_WORDS = 0


def _labelled_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``LABELLED``: in how many toxic and clean documents of either fold each word of a slice stands.

    The row of ``ALL_WORDS`` has the numbers of all their words."""
    for piece in slices(batches):
        words, first = plain_words(piece.column("text"))
        size = np.diff(first)
        kind = np.asarray(piece.column("fold")) + 2 * (1 - np.asarray(piece.column("toxic")))
        doc = np.repeat(np.arange(len(piece)), size)
        order = np.lexsort((doc, words))
        w, d = words[order], doc[order]
        fresh = np.ones(len(w), bool)
        fresh[1:] = (w[1:] != w[:-1]) | (d[1:] != d[:-1])
        word, at = np.unique(w[fresh], return_inverse=True)
        table = np.zeros((len(word) + 1, 4), np.int64)
        np.add.at(table, (at, kind[d[fresh]]), 1)
        table[-1] = np.bincount(kind, size, 4)
        cols = [np.append(word.view(np.int64), ALL_WORDS), *table.T]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in cols], names=[c.split()[0] for c in LABELLED.split(", ")])


# Candidates whose counts travel together, and how many sums of a block are made before the last one.
BLOCK, SUMS = 4096, 1024
BLOCKS = "block int, part int, counts binary"


def _counter(candidates: np.ndarray):
    """Rows of ``BLOCKS``: in how many documents of a task the candidates of each block stand; the number of all
    words follows the last candidate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(candidates) + 1, np.int64)
        for piece in slices(batches):
            words, first = plain_words(piece.column("text"))
            total[-1] += len(words)
            if len(candidates):
                code = np.minimum(np.searchsorted(candidates, words), len(candidates) - 1)
                hit = np.flatnonzero(candidates[code] == words)
                doc = np.searchsorted(first, hit, "right") - 1
                pair = np.unique(doc * len(candidates) + code[hit])
                total[:-1] += np.bincount(pair % len(candidates), minlength=len(candidates))
        task = TaskContext.get()
        blocks = [k for k in range(0, len(total), BLOCK) if total[k : k + BLOCK].any()]
        cols = [pa.array([k // BLOCK for k in blocks], pa.int32()), pa.array([task.partitionId() % SUMS if task else 0] * len(blocks), pa.int32())]
        cols.append(pa.array([total[k : k + BLOCK].tobytes() for k in blocks], pa.binary()))
        yield pa.RecordBatch.from_arrays(cols, names=["block", "part", "counts"])

    return run


def _add(rows: pa.Table) -> pa.Table:
    """One row with the sum of the counts."""
    total = sum(np.frombuffer(x, np.int64) for x in rows.column("counts").to_pylist())
    return rows.slice(0, 1).set_column(2, "counts", pa.array([total.tobytes()], pa.binary()))


def count_everywhere(docs: DataFrame, candidates: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many rows of ``docs`` each of the sorted ``candidates`` stands, and the number of all words.

    A task sends one row per block of candidates; they are added up in two steps, so that no task gets more than a
    thousandth of them.
    """
    sent = docs.select("text").mapInArrow(_counter(candidates), BLOCKS)
    for keys in (["block", "part"], ["block"]):
        sent = sent.groupBy(*keys).applyInArrow(_add, BLOCKS)
    total = np.zeros(len(candidates) + 1, np.int64)
    for r in sent.collect():
        counts = np.frombuffer(r["counts"], np.int64)
        total[r["block"] * BLOCK : r["block"] * BLOCK + len(counts)] = counts
    return total[:-1], int(total[-1])


def log_odds(toxic: np.ndarray, clean: np.ndarray, prior: np.ndarray, n_toxic: float, n_clean: float, weight: float) -> np.ndarray:
    """Log-odds of words under a Dirichlet prior of total ``weight``, drawn towards zero by SHRINK errors."""
    a, b = toxic + prior, clean + prior
    delta = np.log(a / np.maximum(n_toxic + weight - a, 1e-9)) - np.log(b / np.maximum(n_clean + weight - b, 1e-9))
    error = np.sqrt(1 / a + 1 / b)
    return np.sign(delta) * np.maximum(np.abs(delta) - SHRINK * error, 0)


def _words_model(counts: np.ndarray, hashes: np.ndarray, all_words: np.ndarray, toxic: list[int], clean: list[int]) -> Words:
    n_t, n_c = float(all_words[toxic].sum()), float(all_words[clean].sum())
    weight = max(PRIOR * (n_t + n_c), 1.0)
    prior = weight * counts[:, 0] / max(float(all_words[0]), 1.0) + 1e-6
    odds = log_odds(counts[:, toxic].sum(1), counts[:, clean].sum(1), prior, n_t, n_c, weight)
    keep = odds > DRIFTS[0]
    return Words(hashes[keep], np.minimum(odds[keep], TOP))


MATCHED = "n_words long, toxic int, places array<int>, odds array<double>"
SCANNED = "doc_id long, n_words long, score double, scores array<double>, firsts array<int>, lasts array<int>"


def _matches(piece: pa.RecordBatch, models: list[Words], folds: list[int]) -> tuple[np.ndarray, list[tuple[list, list]]]:
    """Words per text, and the known words of each (places, log-odds); with two models a text of fold f is read
    by the model of the other."""
    words, first = plain_words(piece.column("text"))
    found: list[tuple[list, list]] = [([], [])] * len(piece)
    for f, model in enumerate(models):
        hit, odds = model.find(words)
        doc = np.searchsorted(first, hit, "right") - 1
        for a, b in zip(*_stretches(doc)):
            d = int(doc[a])
            if len(models) == 1 or folds[d] != f:
                found[d] = (hit[a:b] - first[d]).tolist(), odds[a:b].tolist()
    return np.diff(first), found


def _parts(places: list[int], odds: list[float], drift: float) -> list[tuple[int, int, float]]:
    """The segments of a text at a drift, from its known words."""
    kept = [(p, o - drift) for p, o in zip(places, odds) if o > drift]
    return segments([p for p, _ in kept], [s for _, s in kept], drift)


def _matcher(models: list[Words]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            size, found = _matches(piece, models, piece.column("fold").to_pylist())
            cols = [pa.array([x[k] for x in found], pa.list_(t)) for k, t in ((0, pa.int32()), (1, pa.float64()))]
            yield pa.RecordBatch.from_arrays([pa.array(size), piece.column("toxic"), *cols], names=["n_words", "toxic", "places", "odds"])

    return run


def _rescored(drift: float):
    """Scores of the segments of matched texts at a drift."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [[s for *_, s in _parts(p, o, drift)] for p, o in zip(b.column("places").to_pylist(), b.column("odds").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("n_words"), b.column("toxic"), pa.array(scores, pa.list_(pa.float64()))], names=["n_words", "toxic", "scores"])

    return run


def _probability(model: Model, n_words: int, scores: list[float]) -> float:
    """The probability that a text with segments of these scores is toxic; no score is too large for it."""
    evidence = float(np.logaddexp(0.0, model.lam * np.array(scores) - math.log(model.k * max(n_words, 1))).sum())
    return float(np.exp(-np.logaddexp(0.0, -(model.intercept + model.slope * evidence))))


def _scanner(model: Model):
    """Score and segments of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            size, matched = _matches(piece, [model.words], [])
            found = [_parts(p, o, model.drift) for p, o in matched]
            score = pa.array([_probability(model, n, [s for *_, s in f]) for n, f in zip(size.tolist(), found)], pa.float64())
            cols = [pa.array([[x[k] for x in f] for f in found], pa.list_(t)) for k, t in ((2, pa.float64()), (0, pa.int32()), (1, pa.int32()))]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(size), score, *cols], names=[c.split()[0] for c in SCANNED.split(", ")])

    return run


def _stretches(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of equal values."""
    if not len(values):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cut = np.flatnonzero(np.diff(values)) + 1
    return np.r_[0, cut], np.r_[cut, len(values)]


def _evidence(k: float, lam: float) -> Column:
    """Sum over segments of log(1 + 1 / E), E = k * n * exp(-lam * score), without a power that overflows."""
    log_kn = F.log(F.lit(k) * F.greatest(F.col("n_words"), F.lit(1)))

    def add(a: Column, s: Column) -> Column:
        x = lam * s - log_kn
        return a + F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))

    return F.aggregate("scores", F.lit(0.0), add)


def logistic(x: np.ndarray, toxic: np.ndarray, clean: np.ndarray, ridge: float = 0.01) -> tuple[float, float]:
    """Intercept and slope for counts of toxic and clean rows at values ``x``, by Newton's method.

    A pseudo-row of either kind at both ends keeps the curve finite when the kinds are apart.
    """
    a, b = 0.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        n = toxic + clean
        g = np.array([(toxic - n * p).sum(), (x * (toxic - n * p)).sum()]) - ridge * np.array([a, b])
        w = n * p * (1 - p)
        h = np.array([[w.sum(), (w * x).sum()], [(w * x).sum(), (w * x * x).sum()]]) + ridge * np.eye(2)
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(max(b, 0.0))


def fit(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> Model:
    """Learn word scores, the chance of segments in clean text, and the curve from evidence to probability.

    Without labels of both kinds every document gets the probability one half, which rejects none.
    """
    texts = docs.select("doc_id", "text")
    known = F.broadcast(training_labels(texts, labels, max_labels))
    labelled = texts.join(known, "doc_id").select("text", "toxic", "fold")
    columns = [c.split()[0] for c in LABELLED.split(", ")]
    sums = labelled.mapInArrow(_labelled_counter, LABELLED).groupBy("word").agg(*[F.sum(c).alias(c) for c in columns[1:]])
    sums = materialize(sums, "labelled-words")
    total = sums.where(F.col("word") == ALL_WORDS).toPandas()[columns[1:]].to_numpy(np.int64).sum(0)
    frequent = sums.where((F.col("word") != ALL_WORDS) & (F.col("toxic0") + F.col("toxic1") >= MIN_DOCS))
    table = frequent.toPandas()
    hashes = table.pop("word").to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    hashes, counts = hashes[order], table.to_numpy(np.int64).reshape(len(hashes), 4)[order]
    everywhere, n_words = count_everywhere(texts, hashes)
    counts = np.c_[everywhere, counts]
    all_words = np.r_[n_words, total]
    crossed = [_words_model(counts, hashes, all_words, [1 + f], [3 + f]) for f in (0, 1)]
    words = _words_model(counts, hashes, all_words, [1, 2], [3, 4])
    matched = materialize(labelled.mapInArrow(_matcher(crossed), MATCHED), "matched")
    best: tuple[float, Model] | None = None
    for drift in DRIFTS:
        rows = materialize(matched.mapInArrow(_rescored(drift), "n_words long, toxic int, scores array<double>"), "rescored")
        clean = rows.where("toxic = 0").agg(
            F.sum("n_words"), F.sum(F.size("scores")), F.sum(F.aggregate("scores", F.lit(0.0), lambda a, s: a + s))
        ).first()
        n_words, n_found, total_score = (float(x or 0) for x in clean)
        # One imaginary segment of score 1 stands for what theory says of log-odds: lambda is 1.
        lam, k = (n_found + 1) / (total_score + 1), (n_found + 0.5) / max(n_words, 1.0)
        x = F.round(F.least(_evidence(k, lam), F.lit(100.0)), 1).alias("x")
        bins = rows.select(x, "toxic").groupBy("x").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).toPandas()
        x, t, c = (bins[name].to_numpy(float) for name in ("x", "t", "c"))
        a, b = logistic(x, t, c) if t.sum() and c.sum() else (0.0, 0.0)
        a = min(a, 0.0)  # a document without evidence is never more likely toxic than not
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        loss = float(-(t * np.log(p) + c * np.log(1 - p)).sum())
        if best is None or loss < best[0]:
            best = loss, Model(words, drift, k, lam, a, b)
    return best[1]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, n_words, n_passages, passages) for every document.

    ``passages`` are the segments, as (first word, last word, score), whose expected number in clean text is
    below one.  A null text counts as empty; a text without words has no passages and the score of one
    without evidence.  Rows that repeat are scored alike; extra columns are ignored.
    """
    found = docs.select("doc_id", "text").mapInArrow(_scanner(model), SCANNED)
    spans = F.arrays_zip(F.col("firsts").alias("first_word"), F.col("lasts").alias("last_word"), F.col("scores").alias("score"))
    rare = F.filter(spans, lambda s: model.k * F.col("n_words") * F.exp(-model.lam * s["score"]) < 1)
    return found.select("doc_id", "score", "n_words", F.size(rare).alias("n_passages"), rare.alias("passages"))


def judge(docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF, max_labels: int = MAX_LABELS) -> DataFrame:
    """Fit on ``labels`` and score all documents: doc_id, held_out, score, predicted and the passages."""
    out = score(docs, fit(docs, labels, max_labels))
    return out.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= cutoff).cast("int").alias("predicted"), "n_passages", "passages"
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF, max_labels: int = MAX_LABELS) -> DataFrame:
    """The documents, with all their columns, that score below ``cutoff``; judged row by row."""
    model = fit(docs, labels, max_labels)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _scanner(model)
        for piece in slices(batches):
            texts = pa.RecordBatch.from_arrays([pa.nulls(len(piece), pa.int64()), piece.column("text")], names=["doc_id", "text"])
            stay = [p < cutoff for found in scan([texts]) for p in found.column("score").to_pylist()]
            yield piece.filter(pa.array(stay, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
