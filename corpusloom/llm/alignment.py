"""Which tokens of two tokenizers cover the same bytes, and how often any two of them meet.

Both tokenizations of a text are arrays of byte offsets where tokens end.  While the two run one to one, entry i
of the first equals entry i + shift of the second; such a stretch is jumped over by probing ahead in doubled
steps, and its end is found by halving the last one.  Where the entries differ, tokens are taken from whichever
side is behind until both end at one byte; that is an irregular group, after which the shift is updated.

How often a pair of ids is linked is counted over the corpus.  Texts are tokenized once: a slice of documents
becomes one row with its distinct pairs, their numbers, and for every link the number of its pair.  Pairs go to
buckets by hash, in packets of one row per slice and bucket.  A bucket adds up its pairs; only the highest count
for each id of the second tokenizer, at most its vocabulary, reaches the driver.  With it the buckets answer
every slice with the counts of its pairs.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import ROLL, materialize, mix, slices
from corpusloom.llm.packing import encoder

# Text bytes of one slice, and pairs that one bucket receives.
SLICE_BYTES = 2_000_000
BUCKET_PAIRS = 2_000_000

SLICE = (
    "slice long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, n_pairs long, pairs binary, times binary, links binary"
)
PACKET = "bucket int, slice long, pairs binary, times binary"
ANSWER = "slice long, pairs binary, counts binary, best binary"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def runs(a: list[int], b: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Runs of groups at one shift: how many tokens of either side end with the first group, and the number of groups.

    Every later group of a run has one token of either side.  ``a`` and ``b`` are ends that agree at last.
    """
    first_a, first_b, number = [], [], []
    i, j, n = 0, 0, len(a)
    while i < n:
        # The group that starts here, regular or not: whichever side is behind goes on until both end at one byte.
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        i += 1
        j += 1
        # One to one from here on: probe in doubled steps at this shift, then halve the last one.
        k, step, shift = i, 4, j - i
        while k < n and a[k : k + step] == b[k + shift : k + shift + step]:
            k += step
            step *= 2
        while step > 1 and k < n:
            step //= 2
            if a[k : k + step] == b[k + shift : k + shift + step]:
                k += step
        if k > n:
            k = n
        first_a.append(i)
        first_b.append(j)
        number.append(k - i + 1)
        i, j = k, k + shift
    return first_a, first_b, number


def groups(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For every group, how many tokens of either side end with it."""
    first_a, first_b, number = (np.array(x, np.int64) for x in runs(a, b))
    later = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    return np.repeat(first_a, number) + later, np.repeat(first_b, number) + later


class Tokenizers:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, first: str, second: str):
        from sentencepiece import SentencePieceProcessor

        a = encoder(first)
        self.first = a.encode
        size = max(a.ranks.values()) + 1
        self.bytes_a = [b""] * size
        for token, k in a.ranks.items():
            self.bytes_a[k] = token
        self.second = SentencePieceProcessor(model_file=second)
        n = self.second.get_piece_size()
        piece = self.second.id_to_piece
        self.bytes_b = [bytes([int(piece(k)[3:5], 16)]) if self.second.is_byte(k) else piece(k).replace("▁", " ").encode() for k in range(n)]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        # Written ids with what follows them: a comma inside of a group's side, else a bar (first) or semicolon.
        self.written = [f"{k}{end}" for ids, close in ((range(size), "|"), (range(n), ";")) for k in ids for end in (",", close)]

    def ids(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of either tokenizer for each text; none for texts that either does not give back byte by byte."""
        for text, b in zip(texts, self.second.encode(texts, num_threads=1)):
            a = self.first(" " + text) if text else []
            whole = b" " + text.encode()
            same = text and b"".join(map(self.bytes_a.__getitem__, a)) == whole and b"".join(map(self.bytes_b.__getitem__, b)) == whole
            yield (a, b) if same else ([], [])


_LOADED: dict[tuple[str, str], Tokenizers] = {}


def tokenizers(first: str, second: str) -> Tokenizers:
    """One pair of tokenizers per worker."""
    if (first, second) not in _LOADED:
        _LOADED[first, second] = Tokenizers(first, second)
    return _LOADED[first, second]


def link_ids(tok: Tokenizers, a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first id, second id) of every pair of tokens that share bytes, in the order of the first tokenizer.

    Every byte offset where a token of either side ends closes one link.  Ends common to both, known from the
    groups, count once.
    """
    ends_a, ends_b = np.cumsum(tok.size_a[a]), np.cumsum(tok.size_b[b])
    alone = np.ones(len(b), bool)
    alone[gb - 1] = False
    at_a = np.r_[np.arange(len(a)), np.searchsorted(ends_a, ends_b[alone])]
    at_b = np.r_[np.searchsorted(ends_b, ends_a), np.flatnonzero(alone)]
    order = np.argsort(at_a, kind="stable")
    return a[at_a[order]], b[at_b[order]]


def group_codes(tok: Tokenizers, a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray) -> np.ndarray:
    """Numbers of the written tokens, group by group, those of the first tokenizer before those of the second."""
    last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    last_a[ga - 1], last_b[gb - 1] = 1, 1
    of_a, of_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    out = np.empty(len(a) + len(b), np.int64)
    out[np.arange(len(a)) + np.r_[0, gb][of_a]] = 2 * a + last_a
    out[np.arange(len(b)) + ga[of_b]] = 2 * (len(tok.bytes_a) + b) + last_b
    return out


def _tokenizer(first: str, second: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizers(first, second)
        pack = zstandard.ZstdCompressor(level=1).compress
        task = TaskContext.get()
        base = (task.partitionId() if task else 0) << 32
        for number, piece in enumerate(slices(batches, limit=limit)):
            counts = np.zeros((len(piece), 4), np.int64)
            shas = []
            pairs = [np.empty(0, np.int64)]
            for k, (ids_a, ids_b) in enumerate(tok.ids([t or "" for t in piece.column("text").to_pylist()])):
                if not ids_a:
                    shas.append("")
                    continue
                a, b = (np.frombuffer(array("q", x), np.int64) for x in (ids_a, ids_b))
                ga, gb = groups(np.cumsum(tok.size_a[a]).tolist(), np.cumsum(tok.size_b[b]).tolist())
                text = "".join(map(tok.written.__getitem__, group_codes(tok, a, b, ga, gb).tolist()))
                shas.append(hashlib.sha256(text[:-1].encode()).hexdigest())
                la, lb = link_ids(tok, a, b, ga, gb)
                pairs.append(la * len(tok.bytes_b) + lb)
                counts[k] = len(a), len(b), len(ga), len(la)
            codes, link, times = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
            row = [base + number, piece.column("doc_id").to_pylist(), *counts.T.tolist(), shas, len(codes)]
            row += [codes.astype(np.int64).tobytes(), times.astype(np.uint32).tobytes(), pack(link.astype(np.uint32).tobytes())]
            yield _batch([row], SLICE)

    return run


_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
_TYPES |= {f"array<{k}>": pa.list_(v) for k, v in _TYPES.items()}


def _batch(rows: list, schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    cols = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[k]) for c, k in zip(cols, kinds)], names=list(names))


def _dealer(n_buckets: int):
    """Packets: the pairs of each slice by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s, pairs, times in zip(*(batch.column(c).to_pylist() for c in ("slice", "pairs", "times"))):
                pairs, times = np.frombuffer(pairs, np.int64), np.frombuffer(times, np.uint32)
                bucket = ((mix(pairs.view(np.uint64) + ROLL) >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")  # pairs stay in order inside a bucket
                pairs, times, bucket = pairs[order], times[order], bucket[order]
                cuts = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)] if len(bucket) else np.zeros(1, np.int64)
                rows = [(int(bucket[x]), s, pairs[x:y].tobytes(), times[x:y].tobytes()) for x, y in zip(cuts[:-1], cuts[1:])]
                yield _batch(rows, PACKET)

    return run


def _totals(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a bucket and their counts over all slices."""
    pairs = np.frombuffer(b"".join(table.column("pairs").to_pylist()), np.int64)
    times = np.frombuffer(b"".join(table.column("times").to_pylist()), np.uint32)
    codes, at = np.unique(pairs, return_inverse=True)
    return codes, np.bincount(at, weights=times, minlength=len(codes)).astype(np.int64)


def _best_of(size_b: int):
    def run(table: pa.Table) -> pa.Table:
        codes, counts = _totals(table)
        most = np.zeros(size_b, np.int64)
        np.maximum.at(most, codes % size_b, counts)
        ids = np.flatnonzero(most)
        return pa.table({"id": pa.array(ids), "most": pa.array(most[ids])})

    return run


def _answerer(most: np.ndarray):
    def run(table: pa.Table) -> pa.Table:
        codes, counts = _totals(table)
        best = counts == most[codes % len(most)]
        rows = []
        for s, pairs in zip(table.column("slice").to_pylist(), table.column("pairs").to_pylist()):
            at = np.searchsorted(codes, np.frombuffer(pairs, np.int64))
            rows.append((s, pairs, counts[at].tobytes(), best[at].tobytes()))
        return pa.Table.from_batches([_batch(rows, ANSWER)])

    return run


def _finish(slice_: pa.Table, answers: pa.Table) -> pa.Table:
    """Rows of the documents of one slice, with the counts of their links summed."""
    pairs = np.frombuffer(b"".join(answers.column("pairs").to_pylist()), np.int64)
    order = np.argsort(pairs)
    count = np.frombuffer(b"".join(answers.column("counts").to_pylist()), np.int64)[order]
    best = np.frombuffer(b"".join(answers.column("best").to_pylist()), bool)[order]
    row = slice_.to_pylist()[0]
    link = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["links"]), np.uint32)
    ends = np.cumsum(row["n_links"])
    sums = [np.r_[0, np.cumsum(x[link], dtype=np.int64)] for x in (best, count)]
    n_best, count_sum = (s[ends] - s[ends - np.array(row["n_links"])] for s in sums)
    cols = (row["doc_id"], row["n_a"], row["n_b"], row["n_groups"], row["n_links"], n_best.tolist(), count_sum.tolist(), row["groups_sha256"])
    return pa.Table.from_batches([_batch(list(zip(*cols)), RESULT)])


def align(docs: DataFrame, first: str, second: str, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per document: token numbers, groups, links, how many links are the most frequent of their second
    id (ties included), the sum of the links' counts, and a digest of the groups.

    ``first`` is a byte-level tokenizer file, which reads a space and the text; ``second`` a SentencePiece model,
    which puts the space before the text itself.  Null and empty texts, and those that one of the two does not
    give back byte by byte, have no tokens: zeros and an empty digest.  Rows that repeat count again, a null
    ``doc_id`` stays, extra columns are ignored, an empty table gives an empty result.
    """
    done = materialize(docs.select("doc_id", "text").mapInArrow(_tokenizer(first, second, slice_bytes), SLICE), "aligned")
    n_pairs = done.agg(F.sum("n_pairs")).first()[0] or 0
    packets = done.select("slice", "pairs", "times").mapInArrow(_dealer(max(8, -(-n_pairs // BUCKET_PAIRS))), PACKET).groupBy("bucket")
    size_b = len(tokenizers(first, second).bytes_b)
    most = np.zeros(size_b, np.int64)
    for r in packets.applyInArrow(_best_of(size_b), "id long, most long").groupBy("id").agg(F.max("most").alias("most")).collect():
        most[r["id"]] = r["most"]
    answers = packets.applyInArrow(_answerer(most), ANSWER)
    return done.drop("n_pairs", "pairs", "times").groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(_finish, RESULT)
