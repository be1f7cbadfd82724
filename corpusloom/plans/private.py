"""Personal-data queries."""

from __future__ import annotations

from corpusloom.operators import pii
from corpusloom.plans.registry import query, r6, table, words_sql


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _kind(v: str, lang: str) -> str:
    return "case " + " ".join(
        f"when regexp_full_match({v}, {_q(p)}) then {_q(k)}" for k, p in pii.rules(lang).items()
    ) + " end"


# One scan per language; i-th value lies between gap i and gap i + 1.
MATCHES = "v as (" + " union all ".join(
    f"""select doc_id, lang, source, text, regexp_extract_all(text, {_q(pii.combined(c))}) as vs,
        regexp_split_to_array(text, {_q(pii.combined(c))}) as gs from documents where lang = {_q(c)}"""
    for c in pii.NATIONAL_ID
) + ")"
FOUND = f"""{MATCHES},
  m as (select doc_id, lang, source, i, vs[i] as value,
          list_sum(list_transform(gs[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(vs[1:i-1], lambda x: length(x))), 0)
            as start
        from (select *, unnest(range(1, len(vs) + 1)) as i from v where len(vs) > 0)),
  f as (select *, case lang {' '.join(f"when {_q(c)} then {_kind('value', c)}" for c in pii.NATIONAL_ID)} end as kind from m)
"""


@query("p1_find_pii", f"with {FOUND} select doc_id, kind, start::bigint as start, value from f")
def p1(spark, sf):
    return pii.find_pii(table(spark, sf, "documents", "doc_id", "lang", "text"))


@query(
    "p2_redact_pii",
    f"""with {FOUND},
    p as (select doc_id, i as pos, 2 as half, '[' || kind || ']' as piece from f
          union all select doc_id, unnest(range(1, len(gs) + 1)), 1, unnest(gs) from v where len(vs) > 0),
    r as (select doc_id, string_agg(piece, '' order by pos, half) as t from p group by 1)
    select doc_id, lang, coalesce(t, text) as text, len(vs)::int as n_redacted from v left join r using (doc_id)""",
)
def p2(spark, sf):
    return pii.redact_pii(table(spark, sf, "documents", "doc_id", "lang", "text"))


@query(
    "p3_drop_pii_dense",
    f"""with {MATCHES}, k as (select doc_id, len({words_sql('text')})::int as n_words,
         coalesce(list_sum(list_transform(vs, lambda x: len({words_sql('x')}))), 0) as hit, len(list_distinct(vs)) as k from v),
    s as (select doc_id, n_words, case when n_words > 0 then hit::double / n_words else 0 end as a,
                 case when n_words > 0 then (k * 1000)::double / n_words else 0 end as b from k)
    select doc_id, n_words, round(a, 6) as pii_share, round(b, 6) as pii_per_1000 from s where a <= 0.02 and b <= 10""",
)
def p3(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "lang", "text")
    out = pii.drop_pii_dense(docs, 0.02, 10.0).drop("lang", "text")
    return out.withColumns({"pii_share": r6("pii_share"), "pii_per_1000": r6("pii_per_1000")})


@query(
    "p4_pii_report",
    f"""with {FOUND}, n as (select source, lang, count(*) as n_docs from documents group by 1, 2)
    select source, lang, any_value(n_docs) as n_docs, {', '.join(
        f"count(*) filter (kind = {_q(k)}) as n_{k.lower()}" for k in pii.KINDS)}
    from n left join f using (source, lang) group by 1, 2""",
)
def p4(spark, sf):
    return pii.pii_report(table(spark, sf, "documents", "lang", "source", "text"), ["source", "lang"])
