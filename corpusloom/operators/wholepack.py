"""Packing whole documents into windows from a histogram of their lengths.

How many documents have each length is all that best-fit decreasing needs: lengths are taken from long to short, and
as many documents of a length as there are windows with the smallest gap that holds it go there at once.  Windows
of one gap have numbers in a row, so the plan is a short table of ranges, as long as the histogram rather than the
corpus.  A document finds its window by its rank among those of its length: a range lookup, no Python worker.

Only documents longer than a window are cut: into whole windows and a rest that is packed like the others.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.ordering import range_rank
from corpusloom.session import materialize

PLAN = "length int, first_rank long, count long, first_window long, offset int"


def plan(histogram: dict[int, int], window: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, count, first window, offset): best-fit decreasing over counts of lengths.

    Of equal gaps the one opened last in the lists is taken first; a new window is opened where no gap is long enough.
    """
    gaps: list[int] = []  # lengths of open gaps, in order
    open_: dict[int, list[tuple[int, int]]] = {}  # gap -> (first window, count)
    out, windows = [], 0

    def add(gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in open_:
                open_[gap] = []
                insort(gaps, gap)
            open_[gap].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                # No gap holds one: new windows, each for as many of this length as it can hold.
                per = window // length
                full, rest = divmod(left, per)
                for k in range(per):
                    n = full + (k < rest)
                    if n:
                        out.append((length, rank, n, windows, k * length))
                        rank += n
                add(window - per * length, windows, full)
                if rest:
                    add(window - rest * length, windows + full, 1)
                    windows += 1
                windows += full
                left = 0
                continue
            gap = gaps[at]
            first, count = open_[gap].pop()
            if not open_[gap]:
                del open_[gap], gaps[at]
            n = min(left, count)
            out.append((length, rank, n, first, window - gap))
            add(gap - length, first, n)
            add(gap, first + n, count - n)
            left, rank = left - n, rank + n
    return out


def pieces(df: DataFrame, window: int, doc: str = "doc_id", tokens: str = "n_tokens") -> DataFrame:
    """(doc, piece, start, length): a document that fits is one piece; of a longer one the first pieces fill windows."""
    n = F.col(tokens).cast("long")
    whole = F.floor((n - 1) / window).cast("int")
    rows = df.where(n > 0).select(doc, n.alias("_n"), F.posexplode(F.sequence(F.lit(0), whole)).alias("piece", "_k"))
    start = F.col("piece").cast("long") * window
    return rows.select(doc, "piece", start.alias("start"), F.least(F.lit(window), F.col("_n") - start).cast("int").alias("length"))


def pack_whole(df: DataFrame, window: int, doc: str = "doc_id", tokens: str = "n_tokens") -> DataFrame:
    """(doc, piece, start, length, sequence_id, offset) for every document with tokens.

    The histogram has at most ``window`` rows; it and the plan made of it pass through the driver.  Documents of no
    or a null number of tokens are left out; rows that share an id are placed one by one; other columns are dropped.
    """
    spark = df.sparkSession
    cut = materialize(pieces(df, window, doc, tokens), "pieces")
    # Full windows take no part: each is a sequence of its own, after all others.
    counts = {r["length"]: r["count"] for r in cut.where(F.col("length") < window).groupBy("length").count().collect()}
    rows = plan(counts, window)
    last = max((first + n for _, _, n, first, _ in rows), default=0)
    ranked = range_rank(cut, [F.col(doc), F.col("piece")], "_rank", ("length",))
    made = spark.createDataFrame([*rows, (window, 0, 1 << 62, last, 0)], PLAN)
    held = (F.col("_rank") >= F.col("first_rank")) & (F.col("_rank") < F.col("first_rank") + F.col("count"))
    placed = ranked.join(made, "length").where(held)
    return placed.select(doc, "piece", "start", "length", (F.col("first_window") + F.col("_rank") - F.col("first_rank")).alias("sequence_id"), "offset")


def fill(packed: DataFrame, window: int) -> DataFrame:
    """One row: sequences, tokens, and the share of their places that tokens take."""
    n, t = F.countDistinct("sequence_id"), F.sum("length")
    return packed.agg(n.alias("n_sequences"), t.alias("n_tokens"), (t / (n * window)).alias("fill"))
