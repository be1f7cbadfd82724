"""Toxicity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import terms as phrases
from corpusloom.operators import toxicity as t
from corpusloom.plans.registry import bare_sql, query, r6, table

TERM_ROWS = ", ".join(
    f"('{lang}', '{w}', '{kind}')" for lang, k in t.TERMS.items() for kind, ws in k.items() for w in ws
)
TOX = f"""terms(lang, term, severity) as (values {TERM_ROWS}),
  b as (select doc_id, lang, unnest({bare_sql('text')}) as term from documents),
  c as (select doc_id, count(*) as n, count(severity) as k, count(*) filter (severity = 'severe') as s
        from b left join terms using (lang, term) group by 1),
  tox as (select doc_id, coalesce(n, 0)::int as n_words, coalesce(k, 0)::int as n_terms, coalesce(s, 0)::int as n_severe,
                 case when n > 0 then k::double / n else 0.0::double end as density,
                 coalesce(k::double / n > 0.01 or s > 0, false) as dropped
          from documents left join c using (doc_id))"""


@query(
    "t1_toxic_density",
    f"with {TOX} select doc_id, n_words, n_terms, n_severe, round(density, 6) as density, dropped from tox",
)
def t1(spark, sf):
    out = t.toxic_density(table(spark, sf, "documents", "doc_id", "lang", "text"))
    return out.select("doc_id", "n_words", "n_terms", "n_severe", r6("density").alias("density"), "dropped")


PHRASES_SQL = f"""with p as (
    select item_id, list_filter({bare_sql('text')}, lambda w: w <> '') as ws from benchmark),
  terms as (select distinct array_to_string(ws[1:k], ' ') as term, k from p, (values (2), (3)) l(k) where len(ws) >= k),
  d as (select doc_id, list_filter({bare_sql('text')}, lambda w: w <> '') as ws from documents),
  g as (select doc_id, k, unnest(list_transform(range(1, greatest(len(ws) - k + 2, 1)), lambda i: array_to_string(ws[i:i + k - 1], ' '))) as term
        from d, (values (2), (3)) l(k))
select doc_id, term, count(*)::bigint as n from g join terms using (term, k) group by doc_id, term"""


def _openings(spark, sf):
    """The table of phrases: the first two and the first three words of every benchmark item."""
    held = table(spark, sf, "benchmark", "item_id", "text").select(phrases.term_words("text").alias("ws"))
    long = held.select("ws", F.explode(F.array(F.lit(2), F.lit(3))).alias("k")).where(F.size("ws") >= F.col("k"))
    return long.select(F.array_join(F.slice("ws", F.lit(1), F.col("k")), " ").alias("term")).distinct()


@query("t1_find_terms", PHRASES_SQL)
def t1_find(spark, sf):
    return phrases.find_terms(table(spark, sf, "documents", "doc_id", "text"), _openings(spark, sf))


@query("t1_find_terms_joined", PHRASES_SQL)
def t1_find_joined(spark, sf):
    return phrases.find_terms(table(spark, sf, "documents", "doc_id", "text"), _openings(spark, sf), max_chars=0)


@query(
    "t2_spam_score",
    f"""with b as (select doc_id, unnest({bare_sql('text')}) as w from documents),
    c as (select doc_id, w, count(*) as n from b where length(w) >= 4 group by 1, 2),
    s as (select doc_id, sum(n)::int as n_terms, max(n)::double / sum(n) as r from c group by 1)
    select doc_id, coalesce(n_terms, 0) as n_terms, round(coalesce(r, 0), 6) as spam_score, coalesce(r, 0) > 0.2 as is_spam
    from documents left join s using (doc_id)""",
)
def t2(spark, sf):
    return t.spam_score(table(spark, sf, "documents", "doc_id", "text")).select(
        "doc_id", "n_terms", r6("spam_score").alias("spam_score"), "is_spam"
    )


@query(
    "t3_url_block",
    r"""with h as (select page_id, url, lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) as host from pages),
    bad(domain) as (select distinct regexp_extract(host, '[^.]+\.[^.]+\.[^.]+$') from h where page_id % 7 = 0)
    select page_id, url, host from h
    where not exists (select 1 from bad where h.host = bad.domain or h.host like '%.' || bad.domain)""",
)
def t3(spark, sf):
    pages = table(spark, sf, "pages", "page_id", "url")
    # The block list is taken from the table itself: the registered domain of every seventh page.
    host = F.lower(F.parse_url("url", F.lit("HOST")))
    domains = pages.where(F.col("page_id") % 7 == 0).select(
        F.regexp_extract(host, r"[^.]+\.[^.]+\.[^.]+$", 0).alias("domain")
    )
    return t.url_block(pages, domains)


def _labelled(spark, sf, label):
    docs = table(spark, sf, "documents", "doc_id", "lang", "text")
    labels = table(spark, sf, "labels", "doc_id", label)
    split = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1) < "c"
    return docs.join(labels, "doc_id").withColumn("is_train", split)


@query("t4_toxicity_classifier")
def t4(spark, sf):
    rows = _labelled(spark, sf, "toxic")
    model = t.train_linear(rows.where("is_train"), "toxic")
    scored = t.score_linear(model, rows, "p_toxic")
    report = t.classifier_report(scored.where("not is_train"), F.col("p_toxic") > 0.5, F.col("toxic"))
    return report.withColumns({"precision": r6("precision"), "recall": r6("recall")})


@query(
    "t5_audit_sample",
    """select doc_id, lang, source, sample_no::int as sample_no from (
       select doc_id, lang, source, row_number() over (partition by lang, source order by md5('11:' || doc_id), doc_id) as sample_no
       from documents) where sample_no <= 3""",
)
def t5(spark, sf):
    return t.audit_sample(table(spark, sf, "documents", "doc_id", "lang", "source"), 3, ["lang", "source"], seed=11)


@query(
    "t6_classifier_report",
    f"""with {TOX}, j as (select lang, (n_terms > 0)::int as p, toxic as a
                          from tox join labels using (doc_id) join (select doc_id, lang from documents) using (doc_id))
    select lang, sum((p = 1 and a = 1)::int)::bigint as tp, sum((p = 1 and a = 0)::int)::bigint as fp,
           sum((p = 0 and a = 1)::int)::bigint as fn, sum((p = 0 and a = 0)::int)::bigint as tn,
           round(coalesce(sum((p = 1 and a = 1)::int)::double / nullif(sum(p), 0), 0), 6) as precision,
           round(coalesce(sum((p = 1 and a = 1)::int)::double / nullif(sum(a), 0), 0), 6) as recall
    from j group by rollup (lang)""",
)
def t6(spark, sf):
    docs = t.toxic_density(table(spark, sf, "documents", "doc_id", "lang", "text"))
    rows = docs.select("doc_id", "lang", "n_terms").join(table(spark, sf, "labels", "doc_id", "toxic"), "doc_id")
    report = t.classifier_report(rows, F.col("n_terms") > 0, F.col("toxic"))
    return report.withColumns({"precision": r6("precision"), "recall": r6("recall")})
