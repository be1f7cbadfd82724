"""Packing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import packing as p
from corpusloom.plans.convert import VOCAB, tok_sql, tokens_of
from corpusloom.plans.registry import query, table
from corpusloom.session import materialize

L = 256
SEED = 1234


def order_sql(epochs: int, separate: bool) -> str:
    """CTEs ending in span(pos, epoch, doc_id, n_tokens, start)."""
    part = f"(epoch = {epochs - 1})::int" if separate else "0"
    return f"""{tok_sql()},
  nt as (select doc_id, count(*)::int as n_tokens from tok group by 1),
  ord as (select doc_id, epoch::int as epoch, n_tokens,
                 row_number() over (order by {part}, md5('{SEED}:' || epoch || ':' || doc_id), doc_id) - 1 as pos
          from nt, range({epochs}) r(epoch)),
  span as (select *, (sum(n_tokens) over (order by pos) - n_tokens)::bigint as start from ord),
  tot as (select sum(n_tokens)::bigint as total from nt)"""


def samples_sql(seq_len: int) -> str:
    """CTEs ending in el(sample_id, i, id): element i of each sample, one epoch."""
    return f"""{order_sql(1, False)},
  flat as (select start + row_number() over (partition by doc_id order by j, b) - 1 as e, id
           from tok join span using (doc_id)),
  el as (select e // {seq_len} as sample_id, e % {seq_len} as i, id from flat, tot where e // {seq_len} < (total - 1) // {seq_len}
         union all
         select e // {seq_len} - 1, {seq_len}, id from flat, tot
         where e % {seq_len} = 0 and e > 0 and e // {seq_len} - 1 < (total - 1) // {seq_len})"""


def _placed(spark, sf, epochs=1, separate=False):
    tok = tokens_of(spark, sf)
    order = p.document_order(tok.select("doc_id", "n_tokens"), epochs, SEED, separate)
    return tok, materialize(p.spans(order, width=300), "spans")


def _samples(spark, sf):
    tok, placed = _placed(spark, sf)
    return p.materialize_samples(placed, tok, L)


def _md5(c):
    return F.md5(F.array_join(c, " "))


@query(
    "n1_split_docs",
    """with r as (select doc_id, row_number() over (order by doc_id) - 1 as position, count(*) over () as n from documents)
    select doc_id, position::bigint as position, case when position < round(0.9::double * n) then 'train'
           when position < round(0.95::double * n) then 'valid' else 'test' end as split from r""",
)
def n1(spark, sf):
    return p.split_docs(table(spark, sf, "documents", "doc_id"), "90,5,5")


@query(
    "n2_document_order",
    f"with {order_sql(3, True)} select pos::bigint as pos, epoch, doc_id, n_tokens, start from span",
)
def n2(spark, sf):
    return _placed(spark, sf, 3, True)[1]


@query(
    "n3_sample_index",
    f"""with {order_sql(2, False)},
    s as (select unnest(range((start + {L - 1}) // {L}, least((start + n_tokens - 1) // {L}, (2 * total - 1) // {L}) + 1)) as sample_id,
                 pos, start from span, tot)
    select sample_id, pos::bigint as doc_pos, sample_id * {L} - start as offset from s""",
)
def n3(spark, sf):
    return p.sample_index(_placed(spark, sf, 2)[1], L)


@query(
    "n4_shuffle_index",
    f"""with {order_sql(2, False)}, s as (select unnest(range(0, (2 * total - 1) // {L} + 1)) as sample_id from tot)
    select row_number() over (order by md5('{SEED}:' || sample_id), sample_id) - 1 as pos, sample_id from s""",
)
def n4(spark, sf):
    return p.shuffle_index(p.sample_index(_placed(spark, sf, 2)[1], L), SEED)


@query(
    "n5_materialize_samples",
    f"""with {samples_sql(L)} select sample_id, count(*)::int as n_tokens, md5(string_agg(id::varchar, ' ' order by i)) as tokens_md5,
        md5(string_agg(id::varchar, ' ' order by i) filter (i < {L})) as inputs_md5,
        md5(string_agg(id::varchar, ' ' order by i) filter (i > 0)) as labels_md5 from el group by 1""",
)
def n5(spark, sf):
    return _samples(spark, sf).select(
        "sample_id",
        F.size("tokens").alias("n_tokens"),
        _md5("tokens").alias("tokens_md5"),
        _md5("inputs").alias("inputs_md5"),
        _md5("labels").alias("labels_md5"),
    )


@query(
    "n6_loss_mask",
    f"""with {samples_sql(L)} select sample_id, sum((id <> 0)::int)::int as n_counted,
        md5(string_agg((id <> 0)::int::varchar, ' ' order by i)) as mask_md5 from el where i < {L} group by 1""",
)
def n6(spark, sf):
    mask = _samples(spark, sf).select("sample_id", p.loss_mask("inputs").alias("m"))
    return mask.select(
        "sample_id", F.aggregate("m", F.lit(0), lambda a, x: a + x).alias("n_counted"), _md5("m").alias("mask_md5")
    )


@query(
    "n7_position_ids",
    f"""with {samples_sql(L)}, q as (select sample_id, i, i - coalesce(max(case when id = 0 then i + 1 end) over (
          partition by sample_id order by i rows between unbounded preceding and 1 preceding), 0) as position from el where i < {L})
    select sample_id, md5(string_agg(position::varchar, ' ' order by i)) as positions_md5, max(position)::int as longest
    from q group by 1""",
)
def n7(spark, sf):
    ids = _samples(spark, sf).select("sample_id", p.position_ids("inputs").alias("q"))
    return ids.select("sample_id", _md5("q").alias("positions_md5"), F.array_max("q").alias("longest"))


@query(
    "n8_cu_seqlens",
    f"""with {samples_sql(L)}, b as (select distinct sample_id, unnest([0, i + 1]) as bound from el where i < {L} and (id = 0 or i = {L - 1})),
    s as (select *, bound - lag(bound) over (partition by sample_id order by bound) as len from b)
    select sample_id, string_agg(bound::varchar, ',' order by bound) as cu_seqlens, max(len)::int as max_seqlen,
           sum(len * (len + 1) // 2)::bigint as n_attended from s group by 1""",
)
def n8(spark, sf):
    # Pairs (i, j) with j <= i and equal segment ids, counted per segment.
    b = _samples(spark, sf).select("sample_id", p.cu_seqlens("inputs").alias("b"))
    pairs = F.aggregate(
        p.segment_lengths(F.col("b")), F.lit(0).cast("long"), lambda a, x: a + (x * (x + 1) / 2).cast("long")
    )
    return b.select(
        "sample_id",
        F.array_join("b", ",").alias("cu_seqlens"),
        p.max_seqlen(F.col("b")).alias("max_seqlen"),
        pairs.alias("n_attended"),
    )


@query(
    "n9_repack",
    f"""with {samples_sql(2 * L)} select sample_id, count(*)::int as n_tokens,
        md5(string_agg(id::varchar, ' ' order by i)) as tokens_md5 from el group by 1""",
)
def n9(spark, sf):
    tok, placed = _placed(spark, sf)
    config = {"input": sf, "content": p.content_key(tok), "vocab": VOCAB, "seed": SEED, "epochs": 1, "seq_len": 2 * L}
    rows = p.cached(spark, config, lambda: p.materialize_samples(placed, tok, 2 * L))
    return rows.select("sample_id", F.size("tokens").alias("n_tokens"), _md5("tokens").alias("tokens_md5"))


@query(
    "n10_pack_stats",
    f"""with {order_sql(2, False)},
    t as (select unnest(range(case when start > 0 then (start - 1) // {L} else 0 end,
                 least((start + n_tokens - 1) // {L}, (2 * total - 1) // {L} - 1) + 1)) as sample_id, pos, total from span, tot),
    d as (select sample_id, count(*) as docs_per_sample, any_value(total) as total from t group by 1)
    select docs_per_sample, count(*) as n_samples, any_value(2 * total - (2 * total - 1) // {L} * {L} - 1)::bigint as tail_tokens
    from d group by 1""",
)
def n10(spark, sf):
    return p.pack_stats(_placed(spark, sf, 2)[1], L)
