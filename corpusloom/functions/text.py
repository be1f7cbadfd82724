"""Row-local text expressions.  None of them shuffles or leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the characters Python's str.split() treats as white space.
WHITE = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


# The same characters in Java's notation, which its regex engine matches several times faster.
JAVA_WHITE = r"(?U)[\s\x1C-\x1F]+"
JAVA_WORD = r"(?U)[^\s\x1C-\x1F]+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    A lambda that mentions an expression evaluates it again for every element; binding it as the
    single element of an array keeps the work linear.
    """
    return F.transform(F.array(value), body)[0]


def hold(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``value`` as a column that the optimizer does not inline into later expressions.

    Needed in front of a Python function: its argument must not hold a nested lambda.
    """
    rest = [c for c in df.columns if c != name]
    return df.select(*rest, F.explode(F.array(value)).alias(name))


def words(text: Column | str) -> Column:
    """White-space separated words (extraction keeps its compiled pattern; a split compiles per row)."""
    return F.regexp_extract_all(col(text), F.lit(JAVA_WORD), F.lit(0))


def word_count(text: Column | str) -> Column:
    """Number of words, without building them."""
    return F.regexp_count(col(text), F.lit(JAVA_WORD))


def lines(text: Column | str) -> Column:
    return F.split(col(text), "\n")


def join_lines(parts: Column) -> Column:
    return F.array_join(parts, "\n")


def visible_chars(text: Column | str) -> Column:
    """Characters that are not white space, i.e. the summed length of all words."""
    return F.length(F.regexp_replace(col(text), JAVA_WHITE, ""))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, 0 where whole is 0."""
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def share_of(items: Column, test) -> Column:
    """Share of array elements that pass ``test``."""
    return let(items, lambda xs: ratio(F.size(F.filter(xs, test)), F.size(xs)))


def word_ngrams(items: Column, n: int) -> Column:
    """Space-joined n-grams of an array of words (empty when there are fewer than n words)."""
    return let(
        items,
        lambda ws: F.when(
            F.size(ws) >= n,
            F.transform(
                F.sequence(F.lit(1), F.size(ws) - (n - 1)), lambda i: F.array_join(F.slice(ws, i, n), " ")
            ),
        ).otherwise(F.array().cast("array<string>")),
    )


def char_ngrams(text: Column, sizes: tuple[int, ...]) -> Column:
    """Character n-grams of all ``sizes``, in time linear in the text (one split into characters)."""

    def grams(chars: Column, n: int) -> Column:
        if n == 1:
            return chars
        return F.when(
            F.size(chars) >= n,
            F.transform(
                F.sequence(F.lit(0), F.size(chars) - n), lambda i: F.concat(*[F.get(chars, i + k) for k in range(n)])
            ),
        ).otherwise(F.array().cast("array<string>"))

    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return let(chars, lambda cs: F.concat(*[grams(cs, n) for n in sizes]))


def top_count(items: Column) -> Column:
    """Count of the most frequent element: runs of the sorted array, linear after the sort."""
    start = F.struct(
        F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best")
    )

    def step(acc, x):
        run = F.when(acc["last"] == x, acc["run"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(F.sort_array(items), start, step, lambda acc: acc["best"])


def chunks(text: Column | str, size: int) -> Column:
    """Consecutive pieces of at most ``size`` characters."""
    return F.regexp_extract_all(col(text), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def md5_long(c: Column | str) -> Column:
    """A non-negative 60-bit hash from the first 15 hex digits of the md5, the same in every engine."""
    return F.conv(F.substring(F.md5(col(c)), 1, 15), 16, 10).cast("long")
