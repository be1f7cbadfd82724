"""Extraction and post-extraction cleaning."""

from __future__ import annotations

import unicodedata
from html.entities import name2codepoint

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusloom.functions.skew import TARGET_ROWS, skew_join
from corpusloom.functions.text import col, join_lines, lines, ratio

# Elements whose content is never prose, and elements that end a line of text.
DROPPED_ELEMENTS = ("script", "style", "head", "nav", "footer", "noscript", "template", "svg")
BLOCK_ELEMENTS = (
    "p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|header|main|aside|blockquote|pre|title|body|html"
)
TAG_REST = r"""[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*>"""

# Named character references, from the table of the standard library (HTML 4) and the one XML adds.
NAMED = {name: chr(code) for name, code in sorted(name2codepoint.items())} | {"apos": "'"}

# Latin ligatures, which canonical composition leaves alone.
LIGATURES = {
    "ﬀ": "ff",
    "ﬁ": "fi",
    "ﬂ": "fl",
    "ﬃ": "ffi",
    "ﬄ": "ffl",
    "ﬅ": "st",
    "ﬆ": "st",
}


def _code_point(n: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


def _references(text: Column) -> Column:
    """Decode &eacute;, &#233; and &#xE9; by rebuilding the text around each ampersand: what a reference stands for is
    not read again, so &#38;lt; and &amp;lt; are both &lt;.  Unknown references stay."""
    known = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])

    def one(part: Column) -> Column:
        name = F.regexp_extract(part, r"^([A-Za-z][A-Za-z0-9]*);", 1)
        dec = F.regexp_extract(part, r"^#([0-9]{1,7});", 1)
        hexa = F.regexp_extract(part, r"^#[xX]([0-9a-fA-F]{1,6});", 1)
        n = F.when(dec != "", dec.cast("long")).when(hexa != "", F.conv(hexa, 16, 10).cast("long"))
        valid = n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF)
        rest = F.regexp_replace(part, r"^#[xX]?[0-9a-fA-F]+;", "")
        char = F.try_element_at(known, name)
        return (
            F.when(char.isNotNull(), F.concat(char, F.substring(part, F.length(name) + 2, F.length(part))))
            .when(valid, F.concat(_code_point(n), rest))
            .otherwise(F.concat(F.lit("&"), part))
        )

    parts = F.split(text, "&")
    rebuilt = F.concat(
        parts[0], F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), one), "")
    )
    return F.when(text.contains("&"), rebuilt).otherwise(text)


def html_text(html: Column | str) -> Column:
    """Plain text of a page: scripts, styles, navigation and comments dropped, blocks kept as lines."""
    t = F.regexp_replace(col(html), r"(?s)<!--.*?-->", "")
    for tag in DROPPED_ELEMENTS:
        t = F.regexp_replace(t, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "\n")
    t = F.regexp_replace(t, rf"(?i)</?(?:{BLOCK_ELEMENTS})\b{TAG_REST}", "\n")
    t = F.regexp_replace(t, rf"</?[a-zA-Z!]{TAG_REST}", "")
    t = _references(t)
    t = F.regexp_replace(t, r"[ \t\r\f\x{A0}]+", " ")
    t = F.regexp_replace(t, r" ?\n[ \n]*", "\n")
    return F.regexp_replace(t, r"^[ \n]+|[ \n]+$", "")


def html_to_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    return pages.withColumn(out, html_text(html))


def dehyphenate(text: Column | str) -> Column:
    """Join words that were hyphenated over a line end."""
    return F.regexp_replace(col(text), r"(\p{L})-\n(\p{L})", "$1$2")


def fold_ligatures(text: Column | str) -> Column:
    t = col(text)
    for lig, plain in LIGATURES.items():
        t = F.replace(t, F.lit(lig), F.lit(plain))
    return t


@F.arrow_udf(StringType())
def _compose(texts: pa.Array) -> pa.Array:
    # Arrow's own utf8_normalize leaves combining marks as they are (pyarrow 23), so this goes text by text.
    return pa.array([None if x is None else unicodedata.normalize("NFC", x) for x in texts.to_pylist()], texts.type)


# The symbols that the Windows Latin code page has at the bytes 80 to 9F, and their bytes.
WINDOWS_SYMBOLS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
WINDOWS_BYTES = bytes.fromhex("80 82 83 84 85 86 87 88 89 8a 8b 8c 8e 91 92 93 94 95 96 97 98 99 9a 9b 9c 9e 9f").decode("latin-1")


def normalize_unicode(text: Column | str) -> Column:
    """Canonical composition plus ligature folding.  Plain-ASCII rows never reach Python."""
    folded = fold_ligatures(text)
    ascii_only = F.length(folded) == F.octet_length(folded)
    return F.coalesce(_compose(F.when(~ascii_only, folded)), folded)


def repair_encoding(text: Column | str) -> Column:
    """Undo UTF-8 that was read as Latin-1 or as the Windows code page, in any script.

    The symbols of the code page go back to their bytes; if all characters then are bytes and together make
    valid UTF-8, that is the text.  Text that was read correctly does not, and stays; so does plain ASCII.
    """
    t = col(text)
    narrow = F.translate(t, WINDOWS_SYMBOLS, WINDOWS_BYTES)
    damaged = t.rlike(r"[^\x00-\x7f]") & narrow.rlike(r"^[\x00-\x{ff}]*$")
    raw = F.encode(F.when(damaged, narrow), "ISO-8859-1").cast("string")
    return F.when(F.is_valid_utf8(raw), raw).otherwise(t)


def valid_text(raw: Column | str) -> Column:
    """Bytes or text with broken UTF-8 sequences replaced."""
    return F.make_valid_utf8(col(raw).cast("string"))


def symbol_share(line: Column) -> Column:
    """Share of characters that are neither letters, marks nor white space."""
    return ratio(F.length(F.regexp_replace(line, r"[\p{L}\p{M}\s]", "")), F.length(line))


def drop_symbol_lines(text: Column | str, limit: float = 0.5) -> Column:
    """Text without the lines whose symbol and digit share exceeds ``limit`` (blank lines stay)."""
    return join_lines(F.filter(lines(text), lambda x: symbol_share(x) <= limit))


def strip_repeated_lines(
    df: DataFrame,
    k: int,
    max_len: int = 120,
    by: str = "source",
    doc: str = "doc_id",
    text: str = "text",
    target: int = TARGET_ROWS,
) -> DataFrame:
    """Remove short lines that occur in at least ``k`` documents of the same source.

    Lines are counted once per document with a partial aggregate, so a header found in a third of all
    documents costs one row per map task; the hit list goes back over a salted join; only line hashes
    and document ids are shuffled, the text joins once on its own id.
    """
    short = F.array_distinct(
        F.filter(lines(text), lambda x: (F.length(F.trim(x)) > 0) & (F.length(x) <= max_len))
    )
    seen = df.select(by, doc, F.explode(F.transform(short, lambda x: F.md5(x))).alias("_line"))
    repeated = seen.groupBy(by, "_line").agg(F.count("*").alias("_docs")).where(F.col("_docs") >= k)
    hits = (
        skew_join(seen, repeated, [by, "_line"], "_docs", [doc], target)
        .groupBy(doc)
        .agg(F.collect_set("_line").alias("_drop"))
    )
    joined = df.join(hits, doc, "left")
    kept = F.filter(
        lines(text), lambda x: ~((F.length(x) <= max_len) & F.array_contains(F.col("_drop"), F.md5(x)))
    )
    return (
        joined.withColumn("n_removed", F.when(F.col("_drop").isNull(), 0).otherwise(F.size(lines(text)) - F.size(kept)))
        .withColumn(text, F.when(F.col("_drop").isNull(), F.col(text)).otherwise(join_lines(kept)))
        .drop("_drop")
    )
