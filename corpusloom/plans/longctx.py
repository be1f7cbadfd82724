"""Long-context composition queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import longctx as c
from corpusloom.operators import wholepack
from corpusloom.plans.convert import tok_sql, tokens_of
from corpusloom.plans.mixture import DOCS, _docs
from corpusloom.plans.registry import query, r6
from corpusloom.session import materialize

EDGES = [50, 200, 1000]
BIN = "case when n_tokens >= 1000 then 1000 when n_tokens >= 200 then 200 when n_tokens >= 50 then 50 else 0 end"
WINDOW = 1024


def _lengths(spark, sf):
    return materialize(_docs(spark, sf).select("doc_id", "source", "n_tokens"), "lengths")


@query(
    "c1_length_profile",
    f"""with {DOCS}, b as (select source, {BIN} as bin, count(*) as n_docs, sum(n_tokens)::bigint as tokens from d group by 1, 2),
    r as (select source, n_tokens, row_number() over (partition by source order by n_tokens) as rn, count(*) over (partition by source) as n from d),
    q as (select source, max(case when rn = ceil(0.5 * n) then n_tokens end) as p50, max(case when rn = ceil(0.9::double * n) then n_tokens end) as p90 from r group by 1)
    select source, bin, n_docs, tokens, p50, p90, round(tokens::double / sum(tokens) over (partition by source), 6) as token_share
    from b join q using (source)""",
)
def c1(spark, sf):
    return c.length_profile(_lengths(spark, sf), EDGES).withColumn("token_share", r6("token_share"))


@query(
    "c2_upsample_long",
    f"""with {DOCS}, f as (select source, sum(n_tokens)::double as a, coalesce(sum(n_tokens) filter (n_tokens >= 1000), 0)::double as l from d group by 1),
    m as (select doc_id, source, n_tokens, case when l > 0 and l < a and l / a < 0.4 then
            case when n_tokens >= 1000 then 0.4::double / (l / a) else (1 - 0.4::double) / (1 - l / a) end else 1.0 end as mult
          from d join f using (source))
    select doc_id, source, n_tokens, round(mult, 6) as multiplier,
           (floor(mult) + (('0x' || substr(md5('0:' || doc_id), 1, 8))::bigint / 4294967296::double < mult - floor(mult))::int)::bigint as copies
    from m""",
)
def c2(spark, sf):
    return c.upsample_long(_lengths(spark, sf), 1000, 0.4).withColumn("multiplier", r6("multiplier"))


@query(
    "c2_upsampled_rows",
    f"""with {DOCS}, f as (select source, sum(n_tokens)::double as a, coalesce(sum(n_tokens) filter (n_tokens >= 1000), 0)::double as l from d group by 1),
    m as (select doc_id, source, n_tokens, case when l > 0 and l < a and l / a < 0.4 then
            case when n_tokens >= 1000 then 0.4::double / (l / a) else (1 - 0.4::double) / (1 - l / a) end else 1.0 end as mult
          from d join f using (source)),
    k as (select *, (floor(mult) + (('0x' || substr(md5('0:' || doc_id), 1, 8))::bigint / 4294967296::double < mult - floor(mult))::int)::bigint as copies from m)
    select source, count(*) as n_rows, sum(n_tokens)::bigint as tokens, sum((n_tokens >= 1000)::int * n_tokens)::bigint as long_tokens
    from (select *, unnest(range(copies)) from k) group by 1""",
)
def c2_rows(spark, sf):
    rows = c.repeat_copies(c.upsample_long(_lengths(spark, sf), 1000, 0.4))
    long = F.when(F.col("n_tokens") >= 1000, F.col("n_tokens")).otherwise(0)
    return rows.groupBy("source").agg(
        F.count("*").alias("n_rows"), F.sum("n_tokens").alias("tokens"), F.sum(long).alias("long_tokens")
    )


@query(
    "c3_length_mix",
    f"""with {DOCS}, q(bin, share) as (values (1000, 0.4::double), (200, 0.3::double), (50, 0.2::double), (0, 0.1::double)),
    b as (select doc_id, source, n_tokens, {BIN} as bin from d),
    r as (select *, (sum(n_tokens) over (partition by bin order by md5('5:' || doc_id), doc_id) - n_tokens)::bigint as tokens_before from b)
    select doc_id, source, n_tokens, bin, tokens_before from r join q using (bin) where tokens_before < share * 100000""",
)
def c3(spark, sf):
    quotas = spark.createDataFrame([(1000, 0.4), (200, 0.3), (50, 0.2), (0, 0.1)], "bin int, share double")
    return c.length_mix(_lengths(spark, sf), quotas, EDGES, 100_000, seed=5)


@query(
    "c4_pack_to_window",
    f"""with {tok_sql()},
    nt as (select doc_id, count(*) as n_tokens from tok group by 1),
    span as (select doc_id, sum(n_tokens) over (order by source, md5('0:' || doc_id), doc_id) - n_tokens as start
             from nt join documents using (doc_id)),
    flat as (select start + row_number() over (partition by doc_id order by j, b) - 1 as e, id from tok join span using (doc_id)),
    tot as (select count(*) as total from tok),
    el as (select e // {WINDOW} as sample_id, e % {WINDOW} as i, id from flat, tot where e // {WINDOW} < (total - 1) // {WINDOW}
           union all select e // {WINDOW} - 1, {WINDOW}, id from flat, tot
           where e % {WINDOW} = 0 and e > 0 and e // {WINDOW} - 1 < (total - 1) // {WINDOW})
    select sample_id::bigint as sample_id, md5(string_agg(id::varchar, ' ' order by i)) as tokens_md5 from el group by 1""",
)
def c4(spark, sf):
    tok = tokens_of(spark, sf, "source")
    packed = c.pack_to_window(tok, tok, WINDOW)
    return packed.select("sample_id", F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


@query("c4_pack_whole")
def c4_whole(spark, sf):
    return wholepack.pack_whole(_lengths(spark, sf), WINDOW)
