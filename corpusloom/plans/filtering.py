"""Heuristic filter queries."""

from __future__ import annotations


from corpusloom.operators import filters as f
from corpusloom.plans.registry import bare_sql, ngrams_sql, query, r6, ratio_sql, table, words_sql

LEN = "list_sum(list_transform(ws, lambda x: length(x)))"
W = f"w as (select *, {words_sql('text')} as ws, string_split(text, chr(10)) as ls from documents)"


def _docs(spark, sf):
    return table(spark, sf, "documents", "doc_id", "lang", "source", "text")


def _flags(spark, sf, flags: dict, *rounded: str):
    cols = {k: (r6(v) if k in rounded else v) for k, v in flags.items()}
    return _docs(spark, sf).select("doc_id", *[c.alias(k) for k, c in cols.items()])


GOPHER = f"""{W}, g as (select doc_id, lang, source, n_chars, len(ws)::int as n_words,
    {ratio_sql(LEN, 'len(ws)')} as mean_word_len,
    {ratio_sql("len(list_filter(ws, lambda x: x like '%...'))", 'len(ws)')} as ellipsis_words from w)"""


@query(
    "f1_gopher",
    f"""with {GOPHER}, o as (select *, n_words between 50 and 100000 as ok_count,
        mean_word_len between 3 and 10 as ok_mean, ellipsis_words <= 0.3 as ok_ellipsis from g)
    select doc_id, n_words, round(mean_word_len, 6) as mean_word_len, round(ellipsis_words, 6) as ellipsis_words,
           ok_count, ok_mean, ok_ellipsis, ok_count and ok_mean and ok_ellipsis as passes from o""",
)
def f1(spark, sf):
    out = f.gopher(_docs(spark, sf)).drop("lang", "source", "text")
    return out.withColumns({"mean_word_len": r6("mean_word_len"), "ellipsis_words": r6("ellipsis_words")})


@query(
    "f2_length",
    f"""with {W} select doc_id, len(ws)::int as n_words, length(text)::int as n_chars,
        len(ws) between 100 and 100000 and length(text) between 1 and 1000000 as ok_length from w""",
)
def f2(spark, sf):
    return _flags(spark, sf, f.length_flags("text"))


@query(
    "f3_mean_word_length",
    f"""with {GOPHER} select doc_id, round(mean_word_len, 6) as mean_word_len,
        mean_word_len between 3 and 10 as ok_mean from g""",
)
def f3(spark, sf):
    return _flags(spark, sf, f.mean_word_flags("text"), "mean_word_len")


@query(
    "f4_symbol_ratio",
    f"""with {W}, s as (select doc_id, {ratio_sql("len(regexp_extract_all(text, '[#|{}]'))", 'len(ws)')} as r from w)
    select doc_id, round(r, 6) as symbol_ratio, r <= 0.1 as ok_symbols from s""",
)
def f4(spark, sf):
    return _flags(spark, sf, f.symbol_flags("text"), "symbol_ratio")


def _line_rule(cond: str, value: str, flag: str, limit: float) -> str:
    return f"""with {W}, s as (select doc_id, {ratio_sql(f'len(list_filter(ls, lambda x: {cond}))', 'len(ls)')} as r from w)
    select doc_id, round(r, 6) as {value}, r <= {limit} as {flag} from s"""


@query(
    "f5_bullet_ratio",
    _line_rule(
        r"regexp_matches(x, '^[ \t]*(?:[-*\x{2022}\x{2023}\x{25CF}]|\d+[.)])[ \t]')", "bullet_ratio", "ok_bullets", 0.9
    ),
)
def f5(spark, sf):
    return _flags(spark, sf, f.bullet_flags("text"), "bullet_ratio")


@query(
    "f6_short_lines",
    _line_rule("length(trim(x, ' ')) < 30", "short_line_ratio", "ok_short_lines", 0.67),
)
def f6(spark, sf):
    return _flags(spark, sf, f.short_line_flags("text"), "short_line_ratio")


@query(
    "f7_ellipsis_lines",
    _line_rule(r"regexp_matches(x, '(?:\.\.\.|\x{2026})[ \t]*$')", "ellipsis_ratio", "ok_ellipsis_lines", 0.3),
)
def f7(spark, sf):
    return _flags(spark, sf, f.ellipsis_line_flags("text"), "ellipsis_ratio")


def _stop_values() -> str:
    return ", ".join(f"('{lang}', '{w}')" for lang, ws in f.STOPWORDS.items() for w in ws)


@query(
    "f8_stopwords",
    f"""with stop(lang, word) as (values {_stop_values()}),
    b as (select doc_id, lang, unnest({bare_sql('text')}) as word from documents),
    s as (select doc_id, count(stop.word)::double / count(*) as r from b left join stop using (lang, word) group by 1)
    select doc_id, round(coalesce(r, 0), 6) as stopword_share, coalesce(r, 0) >= 0.05 as ok_stopwords
    from documents left join s using (doc_id)""",
)
def f8(spark, sf):
    return _flags(spark, sf, f.stopword_flags("text", "lang"), "stopword_share")


@query(
    "f9_boilerplate",
    """select doc_id, n::int as n_boilerplate, n <= 0 as ok_boilerplate from (
       select doc_id, (length(t) - length(replace(t, 'click here', ''))) / 10
                    + (length(t) - length(replace(t, 'terms and conditions', ''))) / 20
                    + (length(t) - length(replace(t, 'cookie policy', ''))) / 13 as n
       from (select doc_id, lower(text) as t from documents))""",
)
def f9(spark, sf):
    return _flags(spark, sf, f.boilerplate_flags("text"))


@query(
    "f10_repetition",
    f"""with {W}, g as (select doc_id, unnest({ngrams_sql('ws', 3)}) as gram from w),
    c as (select doc_id, gram, count(*) as n from g group by 1, 2),
    s as (select doc_id, 1 - count(*)::double / sum(n) as dup, max(n)::double / sum(n) as top from c group by 1)
    select doc_id, round(coalesce(dup, 0), 6) as dup_ngram_share, round(coalesce(top, 0), 6) as top_ngram_share,
           coalesce(dup, 0) <= 0.3 and coalesce(top, 0) <= 0.2 as ok_repetition
    from documents left join s using (doc_id)""",
)
def f10(spark, sf):
    return _flags(spark, sf, f.repetition_flags("text"), "dup_ngram_share", "top_ngram_share")


@query(
    "f11_c4_lines",
    rf"""with l as (select doc_id, unnest(string_split(text, chr(10))) as x,
                   generate_subscripts(string_split(text, chr(10)), 1) as pos from documents),
    m as (select *, regexp_matches(x, '[.!?"][ \t]*$') as punct, contains(lower(x), 'javascript') as js,
                 regexp_matches(x, '{f.PHONE_LINE}') as phone from l)
    select doc_id, count(*)::int as n_lines, (sum((not punct)::int))::int as n_no_punct, sum(js::int)::int as n_javascript,
           sum(phone::int)::int as n_phone, (sum((punct and not js and not phone)::int))::int as n_kept,
           coalesce(string_agg(x, chr(10) order by pos) filter (punct and not js and not phone), '') as text
    from m group by 1""",
)
def f11(spark, sf):
    return f.c4_lines(table(spark, sf, "documents", "doc_id", "text"))


@query(
    "f12_per_lang_thresholds",
    f"""with {GOPHER}, v as (select doc_id, lang, round(mean_word_len, 6) as m from g),
    k as (select *, row_number() over (partition by lang order by m) as rn, count(*) over (partition by lang) as n from v),
    q as (select lang, max(case when rn = ceil(0.25 * n) then m end) as q1, max(case when rn = ceil(0.75 * n) then m end) as q3,
                 max(case when rn = ceil(0.8::double * n) then m end) as p80 from k group by 1)
    select doc_id, lang, m as mean_word_len, round(q1 - 1.5 * (q3 - q1), 6) as low,
           round(q3 + 1.5 * (q3 - q1), 6) as high,
           m between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) as in_range
    from v join q using (lang)""",
)
def f12(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "lang", "text").select(
        "doc_id", "lang", r6(f.mean_word_length("text")).alias("mean_word_len")
    )
    out = f.apply_thresholds(docs, f.iqr_thresholds(docs, "mean_word_len"), "mean_word_len")
    return out.withColumns({"low": r6("low"), "high": r6("high")})


@query(
    "f13_filter_report",
    f"""with {GOPHER},
    fl as (select lang, source, n_chars, (not n_words between 50 and 100000)::int as a,
                  (not mean_word_len between 3 and 10)::int as b,
                  (not len(regexp_extract_all(d.text, '[#|{{}}]'))::double / greatest(n_words, 1) <= 0.1)::int as c
           from g join (select doc_id, text from documents) d using (doc_id)),
    agg as (select lang, source, count(*) as n_rows, sum((a + b + c = 0)::int)::bigint as n_kept,
                sum(a) as fa, sum(b) as fb, sum(c) as fc,
                sum((a = 1 and b + c = 0)::int) as oa, sum((b = 1 and a + c = 0)::int) as ob,
                sum((c = 1 and a + b = 0)::int) as oc,
                sum(a * n_chars) as ca, sum(b * n_chars) as cb, sum(c * n_chars) as cc
            from fl group by rollup (lang, source))
    select lang, source, n_rows, n_kept, rule, n_failed::bigint as n_failed, n_failed_only::bigint as n_failed_only,
           chars_lost::bigint as chars_lost
    from (select lang, source, n_rows, n_kept, 'word_count' as rule, fa as n_failed, oa as n_failed_only, ca as chars_lost from agg
          union all select lang, source, n_rows, n_kept, 'mean_word', fb, ob, cb from agg
          union all select lang, source, n_rows, n_kept, 'symbols', fc, oc, cc from agg)""",
)
def f13(spark, sf):
    docs = table(spark, sf, "documents", "lang", "source", "text", "n_chars")
    rules = {
        "word_count": f.word_count("text").between(50, 100_000),
        "mean_word": f.mean_word_length("text").between(3, 10),
        "symbols": f.symbol_flags("text")["ok_symbols"],
    }
    return f.filter_report(docs, rules, ["lang", "source"])
