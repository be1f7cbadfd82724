"""Language detection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import language as L
from corpusloom.operators import filters
from corpusloom.plans.registry import query, r6, table, words_sql
from corpusloom.session import materialize

TOP_K = 300


def _grams(src: str, ids: str, text: str) -> str:
    one = lambda n: (
        f"select {ids}, unnest(list_transform(range(1, greatest(length(t) - {n - 1}, 0) + 1), "
        f"lambda i: substr(t, i, {n}))) as gram from (select {ids}, lower(replace({text}, chr(10), ' ')) as t from {src})"
    )
    return " union all ".join(one(n) for n in (1, 2, 3))


PROFILES = f"""
  gc as (select lang, gram, count(*) as n from ({_grams('documents', 'lang', 'text')}) group by 1, 2),
  prof as (select lang, gram, n, n::double / t as p, rank from (
      select *, sum(n) over (partition by lang) as t,
             row_number() over (partition by lang order by n desc, gram) as rank from gc) where rank <= {TOP_K})
"""


def _detect(src: str, ids: str, text: str) -> str:
    """CTEs ending in det(ids, best, confidence)."""
    return f"""
  g as ({_grams(src, ids, text)}),
  cnt as (select {ids}, gram, count(*) as c from g group by all),
  sc as (select {ids}, prof.lang as plang, sum(c * (ln(p) - ln(1e-6::double))) as s
         from cnt join prof using (gram) group by all),
  mx as (select *, max(s) over (partition by {ids}) as m, count(*) over (partition by {ids}) as k from sc),
  det as (select {ids}, min(case when s = m then plang end) as best,
                 1.0 / (sum(exp(s - m)) + (4 - any_value(k)) * exp(-any_value(m))) as confidence
          from mx group by {ids})
"""


def _profiles(spark, sf):
    # A trained profile is a stored table: it is read several times below.
    docs = table(spark, sf, "documents", "doc_id", "lang", "text")
    return materialize(L.train_lang_profiles(docs, TOP_K), "profiles")


@query("l1_lang_profiles", f"with {PROFILES} select lang, gram, n, round(p, 9) as p, rank::int as rank from prof")
def l1(spark, sf):
    return _profiles(spark, sf).withColumn("p", F.round("p", 9))


@query(
    "l2_detect_lang",
    f"""with {PROFILES}, {_detect('documents', 'doc_id', 'text')}
    select doc_id, case when confidence >= 0.5 then best else 'unknown' end as lang_pred,
           round(coalesce(confidence, 0), 6) as confidence
    from documents left join det using (doc_id)""",
)
def l2(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text")
    return L.detect_lang(docs, _profiles(spark, sf)).withColumn("confidence", r6("confidence"))


@query(
    "l3_paragraph_lang",
    f"""with {PROFILES},
    paras as (select * from (
        select doc_id, lang as target, unnest(string_split(text, chr(10))) as para,
               generate_subscripts(string_split(text, chr(10)), 1) - 1 as para_no from documents)
        where length(trim(para, ' ')) > 0),
    {_detect('paras', 'doc_id, para_no', 'para')},
    lab as (select paras.doc_id, paras.para_no, case when confidence >= 0.5 and best = target then 1.0 else 0.0 end as hit
            from paras left join det using (doc_id, para_no)),
    sm as (select *, avg(hit) over (partition by doc_id order by para_no rows between 1 preceding and 1 following) as a
           from lab)
    select doc_id, count(*) as n_paragraphs, round(sum((a > 0.5)::int)::double / count(*), 6) as target_share,
           sum((a > 0.5)::int)::double / count(*) >= 0.5 as keep
    from sm group by 1""",
)
def l3(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "lang", "text")
    return L.paragraph_lang(docs, _profiles(spark, sf), F.col("lang")).withColumn("target_share", r6("target_share"))


@query(
    "l4_min_confidence_by_lang",
    f"""with {PROFILES}, {_detect('documents', 'doc_id', 'text')},
    s as (select doc_id, best as lang_pred, round(confidence, 6) as confidence from det),
    q as (select lang_pred, min(case when rn = greatest(ceil(0.1::double * n), 1) then confidence end) as cut
          from (select *, row_number() over (partition by lang_pred order by confidence) as rn,
                       count(*) over (partition by lang_pred) as n from s) group by 1)
    select s.doc_id, s.lang_pred, s.confidence, cut as min_confidence,
           case when confidence >= cut then lang_pred else 'unknown' end as routed
    from s join q using (lang_pred)""",
)
def l4(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text")
    scored = L.detect_lang(docs, _profiles(spark, sf), threshold=0.0).withColumn("confidence", r6("confidence"))
    scored = scored.where(F.col("lang_pred") != "unknown")
    cuts = L.propose_min_confidence(scored, 0.1)
    return L.min_confidence_by_lang(scored, cuts, 0.5).join(
        cuts.select("lang_pred", "min_confidence"), "lang_pred"
    )


@query(
    "l5_lang_noise_audit",
    f"""with w as (select doc_id, lang, {words_sql('text')} as ws from documents),
    n as (select doc_id, lang, (not (len(ws) between 50 and 100000
              and list_sum(list_transform(ws, lambda x: length(x)))::double / len(ws) between 3 and 10))::int as noise
          from w),
    r as (select *, row_number() over (partition by lang order by md5('0:' || doc_id), doc_id) as rn from n)
    select lang, count(*) as n_docs, sum(noise)::bigint as n_noise,
           count(*) filter (rn <= 20) as n_sampled, (sum(noise) filter (rn <= 20))::bigint as n_noise_sampled,
           round(sum(noise)::double / count(*), 6) as noise_share
    from r group by 1""",
)
def l5(spark, sf):
    docs = filters.gopher(table(spark, sf, "documents", "doc_id", "lang", "text"))
    audit = L.lang_noise_audit(docs, ~F.col("passes"), 20)
    return audit.withColumn("noise_share", r6("noise_share"))
