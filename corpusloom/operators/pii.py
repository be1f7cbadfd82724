"""Structured personal data: find, redact, drop, report.

All kinds form one alternation per locale, so a text is scanned once, matches never overlap, and the
order of the rules decides which kind a span has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import let, ratio, words

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"

# Formats that hold everywhere, most specific first; national numbers go in between.
BEFORE_ID = {
    "EMAIL": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
    "DOB": r"(?i:\b(?:born|dob|date of birth|geboren|nacid[oa]|née?)\b)[^\n\d]{0,20}\d{1,2}[/.-]\d{1,2}[/.-]\d{4}\b",
    "CARD": r"\b\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}\b",
    "IP": rf"\b(?:{_OCTET}\.){{3}}{_OCTET}\b",
}
AFTER_ID = {
    "PHONE": r"(?:\+\d{1,3}[ .-]?)?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}\b|\+\d{1,3}[ .-]?\d{4}[ .-]?\d{4}\b",
}
# National numbers by language of the document.
NATIONAL_ID = {
    "en": r"\b\d{3}-\d{2}-\d{4}\b|\b[STFGM]\d{7}[A-Z]\b",
    "fr": r"\b[12]\d{2}(?:0[1-9]|1[0-2])\d{8}(?:\d{2})?\b",
    "de": r"\b\d{2} ?\d{3} ?\d{3} ?\d{3}\b",
    "es": r"\b\d{8}[A-Z]\b|\b[XYZ]\d{7}[A-Z]\b",
}
# Telephone numbers as they are written at home, with or without the calling code.
NATIONAL_PHONE = {
    "en": r"\b0\d{2,4} \d{3,4} \d{3,4}\b",
    "fr": r"(?:\+33 ?|\b0)[1-9](?:[ .-]?\d{2}){4}\b",
    "de": r"(?:\+49[ /-]?|\b0)[1-9]\d{1,4}[ /-]\d{3,8}\b",
    "es": r"(?:\+34 ?|\b)[6789]\d{2}[ .-]?\d{3}[ .-]?\d{3}\b",
}
KINDS = (*BEFORE_ID, "ID", *AFTER_ID)


def rules(lang: str) -> dict[str, str]:
    """Kind -> pattern for one language, in order of precedence."""
    phone = f"{AFTER_ID['PHONE']}|{NATIONAL_PHONE[lang]}"
    return {**BEFORE_ID, "ID": NATIONAL_ID[lang], "PHONE": phone}


def combined(lang: str) -> str:
    return "|".join(f"(?:{p})" for p in rules(lang).values())


def _by_lang(lang: Column, make, default: str = "en") -> Column:
    """make(language code) chosen by the row's language."""
    out = make(default)
    for code in NATIONAL_ID:
        if code != default:
            out = F.when(lang == code, make(code)).otherwise(out)
    return out


def _values(text: Column, lang: Column) -> Column:
    return _by_lang(lang, lambda c: F.regexp_extract_all(text, F.lit(combined(c)), F.lit(0)))


def _gaps(text: Column, lang: Column) -> Column:
    return _by_lang(lang, lambda c: F.split(text, combined(c), -1))


def kind_of(value: Column, lang: Column) -> Column:
    """The first kind whose pattern matches the whole value."""

    def pick(code: str) -> Column:
        out = F.lit(None).cast("string")
        for kind, pattern in reversed(rules(code).items()):
            out = F.when(value.rlike(f"^(?:{pattern})$"), kind).otherwise(out)
        return out

    return _by_lang(lang, pick)


def find_pii(df: DataFrame, doc: str = "doc_id", lang: str = "lang", text: str = "text") -> DataFrame:
    """(doc, kind, start, value), start being the 0-based character position.

    Positions are running sums of gap and value lengths, built inside the row; only found values become rows.
    """
    t, g = F.col(text), F.col(lang)
    parts = df.select(doc, lang, _values(t, g).alias("_v"), F.transform(_gaps(t, g), F.length).alias("_g")).where(
        F.size("_v") > 0
    )
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    walk = F.aggregate(
        F.sequence(F.lit(0), F.size("_v") - 1),
        empty,
        lambda acc, i: F.struct(
            (acc["at"] + F.get("_g", i) + F.length(F.get("_v", i))).alias("at"),
            F.concat(acc["starts"], F.array(acc["at"] + F.get("_g", i))).alias("starts"),
        ),
        lambda acc: acc["starts"],
    )
    rows = parts.select(doc, lang, F.explode(F.arrays_zip(walk.alias("start"), F.col("_v").alias("value"))).alias("_m"))
    return rows.select(
        doc, kind_of(F.col("_m.value"), F.col(lang)).alias("kind"), F.col("_m.start").cast("long").alias("start"), F.col("_m.value").alias("value")
    )


def redact_pii(df: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """Text with typed placeholders; row-local: gaps and placeholders are joined back in order."""
    t, g = F.col(text), F.col(lang)
    marks = F.transform(F.col("_v"), lambda v: F.concat(F.lit("["), kind_of(v, F.col(lang)), F.lit("]")))
    return (
        df.withColumns({"_v": _values(t, g), "_g": _gaps(t, g)})
        .withColumn(
            text,
            F.when(F.size("_v") == 0, t).otherwise(
                F.array_join(
                    F.zip_with(F.col("_g"), marks, lambda gap, mark: F.concat(gap, F.coalesce(mark, F.lit("")))), ""
                )
            ),
        )
        .withColumn("n_redacted", F.size("_v"))
        .drop("_v", "_g")
    )


def pii_density(df: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """Share of words that would be redacted, and distinct instances per 1000 words."""
    t, g = F.col(text), F.col(lang)
    n = F.size(words(text))
    hit = let(_values(t, g), lambda vs: F.aggregate(vs, F.lit(0), lambda acc, v: acc + F.size(words(v))))
    distinct = let(_values(t, g), lambda vs: F.size(F.array_distinct(vs)))
    return df.withColumns({"n_words": n, "pii_share": ratio(hit, n), "pii_per_1000": ratio(distinct * 1000, n)})


def drop_pii_dense(
    df: DataFrame, max_share: float = 0.2, max_per_1000: float = 50.0, lang: str = "lang", text: str = "text"
) -> DataFrame:
    """Documents that are mostly personal data are removed rather than redacted."""
    return pii_density(df, lang, text).where(
        (F.col("pii_share") <= max_share) & (F.col("pii_per_1000") <= max_per_1000)
    )


def pii_report(df: DataFrame, by: list[str], lang: str = "lang", text: str = "text") -> DataFrame:
    """Matches per kind, one column each, for every group (groups without a match included)."""
    t, g = F.col(text), F.col(lang)
    kinds = F.transform(F.col("_v"), lambda v: kind_of(v, F.col(lang)))
    counted = df.withColumn("_v", _values(t, g)).withColumn("_k", kinds)
    per_doc = counted.select(*by, *[F.size(F.filter("_k", _equals(k))).alias(f"n_{k.lower()}") for k in KINDS])
    return per_doc.groupBy(*by).agg(
        F.count("*").alias("n_docs"), *[F.sum(f"n_{k.lower()}").alias(f"n_{k.lower()}") for k in KINDS]
    )


def _equals(kind: str):
    return lambda x: x == kind
