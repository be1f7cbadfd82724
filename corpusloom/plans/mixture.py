"""Mixture queries.  Sizes are white-space words of the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import filters, quality
from corpusloom.operators import mixing as m
from corpusloom.plans.quality import SCORE, _scored
from corpusloom.plans.registry import query, r6, table, words_sql
from corpusloom.session import materialize, stage_path
from corpusloom.sources import io

DOCS = f"d as (select doc_id, lang, source, regexp_extract(source, '[0-9]+')::int as num, len({words_sql('text')})::bigint as n_tokens from documents)"
SIZES = f"{DOCS}, s as (select lang, sum(n_tokens)::bigint as tokens from d group by 1)"
CATALOG = f"""{DOCS}, cat as (
  select upper(lang) as lang, case when num % 2 = 0 then 'CC' else 'nonCC' end as quality, 'mixed' as domain,
         upper(lang) || '_' || source || case when num % 3 <> 0 then '' when doc_id % 4 = 0 then '-head-25'
           when doc_id % 4 = 3 then '-tail-25' else '-middle-50' end as dataset, sum(n_tokens)::bigint as tokens
  from d group by all)"""
RATIOS = {"EN": 0.4, "FR": 0.3, "DE": 0.25, "ES": 0.1, "XX": 0.0}
CC_RATIOS = {"EN": 0.8, "DE": 0.5}


def _values(d: dict) -> str:
    return ", ".join(f"('{k}', {v}::double)" for k, v in d.items())


STEP1 = f"""{CATALOG}, lr(lang, ratio) as (values {_values(RATIOS)}), ccr(lang, r) as (values {_values(CC_RATIOS)}),
  st1 as (select lang, ratio / sum(ratio) over () as share from lr where ratio > 0)"""
STEP2 = f"""{STEP1},
  nat as (select lang, sum(case when quality = 'CC' then tokens else 0 end)::double / sum(tokens) as nat from cat group by 1),
  rr as (select st1.lang, share, coalesce(r, nat, 0) as cc from st1 left join ccr using (lang) left join nat using (lang)),
  st2 as (select lang, 'CC' as quality, share * cc as share from rr union all select lang, 'nonCC', share * (1 - cc) from rr)"""
STEP3 = f"""{STEP2},
  lg as (select lang, quality, regexp_replace(dataset, '-(head-25|middle-50|tail-25)$', '') as prefix, sum(tokens)::bigint as tokens,
           sum(tokens) filter (dataset like '%-head-25') as h, sum(tokens) filter (dataset like '%-middle-50') as mi,
           sum(tokens) filter (dataset like '%-tail-25') as t from cat group by 1, 2, 3),
  st3 as (select lg.*, share * case when quality = 'CC' then 1.0::double / count(*) over (partition by lang, quality)
                  else tokens::double / sum(tokens) over (partition by lang, quality) end as weight
          from lg join st2 using (lang, quality))"""
STEP4 = f"""{STEP3},
  dl as (select *, coalesce(h, 0)::double as hh, coalesce(mi, 0)::double as mm, coalesce(t, 0)::double as tt,
           case when coalesce(h, 0) = 0 then 0.0::double when coalesce(t, 0) > h then least(t::double / h - 1, 1.0)
                else 0.5 * coalesce(t, 0)::double / h end as delta from st3),
  st4 as (select lang, quality, prefix as dataset, tokens, weight from dl where h is null and mi is null and t is null
          union all select lang, quality, prefix || '-head-25', h, weight * hh / (hh + mm + tt) * (1 + delta) from dl where h is not null
          union all select lang, quality, prefix || '-middle-50', mi, weight * mm / (hh + mm + tt) from dl where mi is not null
          union all select lang, quality, prefix || '-tail-25', t, weight * (tt - hh * delta) / (hh + mm + tt) from dl where t is not null)"""


def _docs(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "lang", "source", "text")
    return docs.select(
        "doc_id", "lang", "source", F.regexp_extract("source", "[0-9]+", 0).cast("int").alias("num"),
        filters.word_count("text").cast("long").alias("n_tokens"),
    )


def _sizes(spark, sf):
    return materialize(_docs(spark, sf).groupBy("lang").agg(F.sum("n_tokens").alias("tokens")), "sizes")


def _catalog(spark, sf):
    suffix = F.when(F.col("num") % 3 != 0, "").when(F.col("doc_id") % 4 == 0, "-head-25").when(
        F.col("doc_id") % 4 == 3, "-tail-25"
    ).otherwise("-middle-50")
    rows = _docs(spark, sf).groupBy(
        F.upper("lang").alias("lang"),
        F.when(F.col("num") % 2 == 0, "CC").otherwise("nonCC").alias("quality"),
        F.lit("mixed").alias("domain"),
        F.concat(F.upper("lang"), F.lit("_"), "source", suffix).alias("dataset"),
    ).agg(F.sum("n_tokens").alias("tokens"))
    return materialize(rows, "catalog")


def _pairs(spark, d: dict, name: str):
    return spark.createDataFrame(list(d.items()), f"lang string, {name} double")


def _weights(spark, sf):
    return m.cascade(_catalog(spark, sf), _pairs(spark, RATIOS, "ratio"), _pairs(spark, CC_RATIOS, "cc_ratio"))


def r9(c):
    return F.round(c, 9)


@query("m1_temperature", f"with {SIZES} select lang, tokens, round(pow(tokens, 0.3::double) / sum(pow(tokens, 0.3::double)) over (), 9) as weight from s")
def m1(spark, sf):
    return m.temperature(_sizes(spark, sf), 0.3).withColumn("weight", r9("weight"))


@query(
    "m2_unimax",
    f"""with recursive {SIZES}, o as (select *, row_number() over (order by tokens, lang) as i, count(*) over () as n from s),
    -- one language after the other, as the method is usually stated
    step(i, left_over, given) as (
      select 0::bigint, 900000.0::double, 0.0::double
      union all
      select o.i, left_over - least(3.0 * tokens, left_over / (n - o.i + 1)), least(3.0 * tokens, left_over / (n - o.i + 1))
      from step join o on o.i = step.i + 1)
    select lang, tokens, round(given, 6) as allocation, round(given / tokens, 6) as epochs,
           round(given / sum(given) over (), 9) as weight, round(greatest(900000.0 - sum(given) over (), 0), 6) as unallocated,
           given = 3.0 * tokens as capped
    from step join o using (i)""",
)
def m2(spark, sf):
    out = m.unimax(_sizes(spark, sf), 900_000, 3)
    return out.withColumns(
        {c: r6(c) for c in ("allocation", "epochs", "unallocated")} | {"weight": r9("weight")}
    )


@query(
    "m3_epoch_report",
    f"""with {SIZES}, w as (select *, pow(tokens, 0.3::double) / sum(pow(tokens, 0.3::double)) over () as weight from s),
    e as (select *, weight * 1500000 / tokens as epochs from w)
    select lang, tokens, round(weight, 9) as weight, round(epochs, 6) as epochs, epochs > 4 as over_cap,
           case when epochs <= 1 then 'unique' when epochs <= 4 then 'full' when epochs <= 16 then 'diminishing'
                when epochs < 44 then 'half' else 'harmful' end as value from e""",
)
def m3(spark, sf):
    out = m.epoch_report(m.temperature(_sizes(spark, sf), 0.3), 1_500_000)
    return out.withColumns({"weight": r9("weight"), "epochs": r6("epochs")})


@query(
    "m4_language_shares",
    """with r as (select lang, case when lang = 'es' then 0 else sqrt(count(*)) end as ratio from documents group by 1)
    select lang, round(ratio / sum(ratio) over (), 9) as share from r where ratio > 0""",
)
def m4(spark, sf):
    # Ratios by the square root of the documents of a language; one language is switched off.
    n = table(spark, sf, "documents", "lang").groupBy("lang").agg(F.sqrt(F.count("*")).alias("ratio"))
    ratios = n.withColumn("ratio", F.when(F.col("lang") == "es", 0.0).otherwise(F.col("ratio")))
    return m.language_shares(ratios).withColumn("share", r9("share"))


@query("m5_quality_shares", f"with {STEP2} select lang, quality, round(share, 9) as share from st2")
def m5(spark, sf):
    langs = m.language_shares(_pairs(spark, RATIOS, "ratio"))
    out = m.quality_shares(langs, _catalog(spark, sf), _pairs(spark, CC_RATIOS, "cc_ratio"))
    return out.withColumn("share", r9("share"))


@query(
    "m6_collapse_triplets",
    f"with {STEP3} select lang, quality, prefix, tokens, h::bigint as head, mi::bigint as middle, t::bigint as tail from lg",
)
def m6(spark, sf):
    return m.collapse_triplets(_catalog(spark, sf))


@query("m7_dataset_shares", f"with {STEP3} select lang, quality, prefix, tokens, round(weight, 9) as weight from st3")
def m7(spark, sf):
    cat = _catalog(spark, sf)
    langs = m.language_shares(_pairs(spark, RATIOS, "ratio"))
    pairs = m.quality_shares(langs, cat, _pairs(spark, CC_RATIOS, "cc_ratio"))
    out = m.dataset_shares(pairs, m.collapse_triplets(cat))
    return out.select("lang", "quality", "prefix", "tokens", r9("weight").alias("weight"))


@query("m8_tail_to_head", f"with {STEP4} select lang, quality, dataset, tokens::bigint as tokens, round(weight, 9) as weight from st4")
def m8(spark, sf):
    return _weights(spark, sf).withColumn("weight", r9("weight"))


@query(
    "m9_check_sum",
    f"""with {STEP4}, t as (select sum(weight) as total from st4 where weight > 0)
    select lang, quality, dataset, tokens::bigint as tokens, round(weight, 9) as weight, round(total, 9) as total,
           abs(total - 1) <= 1e-8 as sums_to_one from st4, t where weight > 0""",
)
def m9(spark, sf):
    return m.check_sum(_weights(spark, sf)).withColumns({"weight": r9("weight"), "total": r9("total")})


PARTS = {"text": 0.6, "math": 0.16, "code": 0.16, "parallel": 0.08}


@query(
    "m10_replay_mix",
    f"""with {DOCS}, k as (select *, ['text', 'math', 'code', 'parallel'][num % 4 + 1] as kind from d),
    parts(kind, part) as (values {_values(PARTS)}),
    b as (select kind, part * (select sum(n_tokens) * 0.25::double / 0.75::double from d where lang <> 'en') as budget from parts),
    r as (select *, sum(n_tokens) over (partition by kind order by md5('0:' || doc_id), doc_id) - n_tokens as before
          from k where lang = 'en')
    select doc_id, kind, n_tokens, 'new' as origin from k where lang <> 'en'
    union all select doc_id, kind, n_tokens, 'replay' from r join b using (kind) where before < budget""",
)
def m10(spark, sf):
    kind = F.element_at(F.array(*[F.lit(k) for k in PARTS]), (F.col("num") % 4 + 1).cast("int"))
    docs = _docs(spark, sf).withColumn("kind", kind).select("doc_id", "lang", "kind", "n_tokens")
    parts = spark.createDataFrame(list(PARTS.items()), "kind string, part double")
    new, old = docs.where("lang <> 'en'").drop("lang"), docs.where("lang = 'en'").drop("lang")
    return m.replay_mix(new, old, 0.25, parts)


@query(
    "m11_phase_mix",
    f"""with {DOCS}, q as (select doc_id, row_number() over (partition by lang order by {SCORE} desc, doc_id) - 1
                                < ceil(0.15::double * count(*) over (partition by lang)) as in_top from documents),
    z as (select lang, sum(n_tokens) as a, sum(n_tokens) filter (in_top) as t from d join q using (doc_id) group by 1),
    u as (select 1 as phase, lang, a::bigint as tokens from z where a >= 45000
          union all select 2, lang, (case when a < 45000 then a else t end)::bigint from z),
    w as (select *, pow(tokens, 0.3::double) / sum(pow(tokens, 0.3::double)) over (partition by phase) as weight from u)
    select phase, lang, tokens, round(weight, 9) as weight,
           round(weight * case phase when 1 then 0.85::double else 1 - 0.85::double end * 1000000, 4) as budget from w""",
)
def m11(spark, sf):
    ranked = quality.ranked(_scored(spark, sf, "lang").drop("text"), "score", ("lang",))
    top = ranked.select("doc_id", (F.col("rank") < F.ceil(F.lit(0.15) * F.col("n"))).alias("in_top"))
    docs = _docs(spark, sf).select("doc_id", "lang", "n_tokens").join(top, "doc_id")
    out = m.phase_mix(docs, 1_000_000, scarce_below=45_000)
    return out.withColumns({"weight": r9("weight"), "budget": F.round("budget", 4)})


@query("m12_regmix")
def m12(spark, sf):
    # Every source is a given mixture of languages, scored by a measured number: its characters per word.
    docs = table(spark, sf, "documents", "lang", "source", "text", "n_chars")
    langs = ["de", "en", "es", "fr"]
    amount = F.sum("n_chars")
    mix = F.array(*[F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("n_chars"))), F.lit(0)) / amount for x in langs])
    words = F.sum(F.size(F.filter(F.split("text", "[ \t\r\n\f]+"), lambda w: w != "")))
    proxies = materialize(docs.groupBy("source").agg(mix.alias("mix"), (amount / words).alias("loss")), "proxies")
    best = m.regmix(proxies, m.dirichlet(spark, 100_000, [1.0] * 4, seed=2), top=10)
    return best.select("mix_id", F.array_join(F.transform("mix", lambda x: F.round(x, 6).cast("string")), ",").alias("mix"), r6("predicted_loss").alias("predicted_loss"))


COMPONENT = {"fr": "new_language", "de": "new_language", "en": "english", "es": "parallel"}


@query(
    "m13_composition_check",
    f"""with {SIZES}, bands(component, low, high) as (values {', '.join(f"('{k}', {a}::double, {b}::double)" for k, (a, b) in m.COMPOSITION.items())}),
    c as (select case lang {' '.join(f"when '{k}' then '{v}'" for k, v in COMPONENT.items())} end as component, sum(tokens)::bigint as tokens from s group by 1),
    z as (select component, coalesce(tokens, 0) as tokens, coalesce(tokens::double / (select sum(tokens) from c), 0) as share, low, high
          from bands left join c using (component))
    select component, tokens, round(share, 6) as share, low, high,
           case when share < low then 'below' when share > high then 'above' else 'ok' end as status from z""",
)
def m13(spark, sf):
    name = F.lit(None).cast("string")
    for k, v in COMPONENT.items():
        name = F.when(F.col("lang") == k, v).otherwise(name)
    bands = spark.createDataFrame([(k, *v) for k, v in m.COMPOSITION.items()], "component string, low double, high double")
    mix = _sizes(spark, sf).select(name.alias("component"), "tokens")
    return m.composition_check(mix, bands).withColumn("share", r6("share"))


# ---- specifications ----------------------------------------------------------------------------
@query("s7_read_catalog", f"with {CATALOG} select lang, quality, domain, dataset, tokens from cat")
def s7(spark, sf):
    path = stage_path(spark, "catalog-json")
    io.write_catalog(_catalog(spark, sf), path)
    return io.read_catalog(spark, path)


@query(
    "s7_check_sources",
    f"""with {CATALOG} select lang, quality, domain, dataset, tokens from cat where dataset not in (
          select upper(lang) || '_' || source from d where doc_id in (select doc_id from labels))""",
)
def s7_check(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "lang", "source").join(table(spark, sf, "labels", "doc_id"), "doc_id")
    have = docs.select(F.concat(F.upper("lang"), F.lit("_"), "source").alias("dataset"))
    return io.check_sources(_catalog(spark, sf), have, fail=False)


@query("s8_read_blend", f"with {STEP4} select 'all' as split, dataset, round(weight, 9) as weight from st4 where weight > 0")
def s8(spark, sf):
    path = stage_path(spark, "blend-text")
    io.write_blend(_weights(spark, sf)).select(F.array_join("blend", " ")).coalesce(1).write.text(path)
    return io.read_blend(spark, blend=path).select("split", "dataset", r9("weight").alias("weight"))


@query(
    "s9_write_blend",
    f"""with {STEP4}, z as (select count(*) as n, sum(weight) as t from st4 where weight > 0)
    select n as n_datasets, round(t, 9) as total, abs(t - 1) <= 1e-8 as ok, (2 * n)::int as length from z""",
)
def s9(spark, sf):
    out = io.write_blend(_weights(spark, sf))
    return out.select("n_datasets", r9("total").alias("total"), "ok", F.size("blend").alias("length"))
