"""Extraction and cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import clean
from corpusloom.plans.registry import query, table


def _sub(expr: str, pattern: str, to: str) -> str:
    return f"regexp_replace({expr}, '{pattern.replace(chr(39), chr(39) * 2)}', {to}, 'g')"


def _html_sql() -> str:
    t = _sub("html", r"(?s)<!--.*?-->", "''")
    for tag in clean.DROPPED_ELEMENTS:
        t = _sub(t, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "chr(10)")
    t = _sub(t, rf"(?i)</?(?:{clean.BLOCK_ELEMENTS})\b{clean.TAG_REST}", "chr(10)")
    t = _sub(t, rf"</?[a-zA-Z!]{clean.TAG_REST}", "''")
    return t


def _decoded_sql(t: str) -> str:
    """Named and numeric references in one pass; ``m`` is the map of names."""
    names = "regexp_extract(p, '^([A-Za-z][A-Za-z0-9]*);', 1)"
    dec, hexa = "regexp_extract(p, '^#([0-9]{1,7});', 1)", "regexp_extract(p, '^#[xX]([0-9a-fA-F]{1,6});', 1)"
    n = f"(case when {dec} <> '' then {dec}::bigint when {hexa} <> '' then ('0x' || {hexa})::bigint end)"
    one = (
        f"case when m[{names}] is not null then m[{names}] || substr(p, length({names}) + 2) "
        f"when {n} between 1 and 55295 or {n} between 57344 and 1114111 then chr({n}::int) || regexp_replace(p, '^#[xX]?[0-9a-fA-F]+;', '') "
        "else '&' || p end"
    )
    return f"string_split({t}, '&')[1] || array_to_string(list_transform(string_split({t}, '&')[2:], lambda p: {one}), '')"


def _spaced_sql(t: str) -> str:
    t = _sub(t, r"[ \t\r\f\x{A0}]+", "' '")
    t = _sub(t, r" ?\n[ \n]*", "chr(10)")
    return _sub(t, r"^[ \n]+|[ \n]+$", "''")


_NAMES = "map {" + ", ".join(f"'{k}': chr({ord(v)})" for k, v in clean.NAMED.items()) + "}"


@query(
    "x1_html_to_text",
    f"""with ent as (select {_NAMES} as m), bare as (select page_id, url, {_html_sql()} as t from pages),
    decoded as (select page_id, url, {_decoded_sql('t')} as t from bare, ent)
    select page_id, url, {_spaced_sql('t')} as text from decoded""",
)
def x1(spark, sf):
    return clean.html_to_text(table(spark, sf, "pages")).select("page_id", "url", "text")


@query(
    "x2_strip_repeated_lines",
    r"""
    with l as (select doc_id, source, pos, line from (
                 select doc_id, source, unnest(string_split(text, chr(10))) as line,
                        generate_subscripts(string_split(text, chr(10)), 1) as pos from documents)),
    rep as (select source, line from l
            where length(trim(line, ' ')) > 0 and length(line) <= 120
            group by 1, 2 having count(distinct doc_id) >= 3),
    k as (select l.* from l left join rep using (source, line) where rep.line is null)
    select d.doc_id, d.source, (len(string_split(d.text, chr(10))) - coalesce(n, 0))::int as n_removed,
           coalesce(t, '') as text
    from documents d left join (
        select doc_id, count(*) as n, string_agg(line, chr(10) order by pos) as t from k group by 1) using (doc_id)
    """,
)
def x2(spark, sf):
    return clean.strip_repeated_lines(table(spark, sf, "documents", "doc_id", "source", "text"), k=3)


@query(
    "x3_dehyphenate",
    r"""select doc_id, regexp_replace(text, '(\p{L})-\n(\p{L})', '\1\2', 'g') as text,
        (text <> regexp_replace(text, '(\p{L})-\n(\p{L})', '\1\2', 'g')) as changed from
        (select doc_id, regexp_replace(text, '(ing|tion|que) ', '\1-' || chr(10), 'g') as text from documents)""",
)
def x3(spark, sf):
    # The tables hold no hyphenated line ends, so word ends are broken first.
    broken = table(spark, sf, "documents", "doc_id", "text").withColumn(
        "text", F.regexp_replace("text", "(ing|tion|que) ", "$1-\n")
    )
    fixed = broken.withColumn("_t", clean.dehyphenate("text"))
    return fixed.select("doc_id", F.col("_t").alias("text"), (F.col("text") != F.col("_t")).alias("changed"))


@query(
    "x4_normalize_unicode",
    """select doc_id, nfc_normalize(replace(replace(replace(replace(replace(replace(replace(
        text, 'ﬀ', 'ff'), 'ﬁ', 'fi'), 'ﬂ', 'fl'), 'ﬃ', 'ffi'), 'ﬄ', 'ffl'), 'ﬅ', 'st'), 'ﬆ', 'st')) as text
       from documents""",
)
def x4(spark, sf):
    # Input is decomposed on purpose so that composition has work to do.
    docs = table(spark, sf, "documents", "doc_id", "text")
    split = F.replace(F.replace("text", F.lit("\u00e9"), F.lit("e\u0301")), F.lit("fi"), F.lit("\ufb01"))
    return docs.select("doc_id", clean.normalize_unicode(split).alias("text"))


@query(
    "x4_repair_encoding",
    "select doc_id, text from documents",
)
def x4_repair(spark, sf):
    # Every text is broken first, by Latin-1 or by the Windows code page; the repair must give it back.
    docs = table(spark, sf, "documents", "doc_id", "text")
    latin = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    windows = F.translate(latin, clean.WINDOWS_BYTES, clean.WINDOWS_SYMBOLS)
    broken = F.when(F.col("doc_id") % 2 == 0, latin).otherwise(windows)
    return docs.select("doc_id", clean.valid_text(clean.repair_encoding(broken)).alias("text"))


@query(
    "x5_drop_symbol_lines",
    r"""select doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x:
          case when length(x) > 0
               then length(regexp_replace(x, '[\p{L}\p{M}\s]', '', 'g'))::double / length(x) else 0.0 end <= 0.15),
          chr(10)) as text from documents""",
)
def x5(spark, sf):
    return table(spark, sf, "documents", "doc_id", "text").withColumn("text", clean.drop_symbol_lines("text", 0.15))
