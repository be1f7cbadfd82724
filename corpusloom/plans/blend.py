"""Blending queries.  Datasets are the document languages, samples are documents."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusloom.functions import permute as pm
from corpusloom.functions.ordering import hash_rank
from corpusloom.operators import blending as b
from corpusloom.plans.registry import query, r6, table
from corpusloom.session import materialize


def weights_sql(alpha: float, name: str = "wt") -> str:
    """CTE name(dataset_id, dataset, size, weight): temperature weights over characters, six decimals."""
    return f"""{name} as (select row_number() over (order by lang) - 1 as dataset_id, lang as dataset, size,
        round(pow(chars, {alpha}::double) / sum(pow(chars, {alpha}::double)) over (), 6) as weight
        from (select lang, count(*) as size, sum(n_chars)::double as chars from documents group by 1))"""


def _weights(spark, sf, alpha):
    docs = table(spark, sf, "documents", "lang", "n_chars")
    size = docs.groupBy(F.col("lang").alias("dataset")).agg(
        F.count("*").alias("size"), F.sum("n_chars").cast("double").alias("chars")
    )
    p = F.pow("chars", F.lit(alpha))
    total = size.agg(F.sum(p)).scalar()
    # One row per dataset: numbering them is a window over a handful of rows.
    return materialize(
        size.withColumn("t", total).select(
            (F.row_number().over(W.orderBy("dataset")) - 1).cast("long").alias("dataset_id"),
            "dataset",
            "size",
            F.round(p / F.col("t"), 6).alias("weight"),
        ),
        "weights",
    )


def _n(spark, sf):
    return table(spark, sf, "documents", "doc_id").count()


# position, dataset_id, dataset_sample_id in (k + 0.5) / weight order
def scalable_sql(n: str, wt: str = "wt", name: str = "bl") -> str:
    return f"""{name} as (select * from (
      select row_number() over (order by (k + 0.5::double) / weight, dataset_id) - 1 as position, dataset_id, k as dataset_sample_id
      from (select *, unnest(range(0, ceil({n} * weight)::bigint + 3)) as k from {wt})) where position < {n})"""


N_SQL = "(select count(*) from documents)"

EXACT = f"""{weights_sql(0.3)},
  ws as (select list(weight order by dataset_id) as w from wt),
  g(i, counts, best) as (
    select 0::bigint, list_transform(w, lambda x: 0::bigint), 0::bigint from ws
    union all
    select i + 1, list_transform(counts, lambda c, k: c + (k = bst)::bigint), bst from (
      select i, counts, list_position(err, list_max(err))::bigint as bst from (
        select i, counts, list_transform(w, lambda x, k: x * greatest(i, 1)::double - counts[k]) as err
        from g, ws where i < 3 * {N_SQL}))),
  ex as (select i - 1 as position, best - 1 as dataset_id, counts[best] - 1 as dataset_sample_id from g where i > 0)"""


@query(
    "b1_dataset_sizes",
    f"""with {weights_sql(0.3)} select dataset_id, dataset, size, weight,
        ceil(ceil({N_SQL} * weight) * (1 + 0.005::double))::bigint as need,
        ceil(ceil({N_SQL} * weight) * (1 + 0.005::double)) > size as short from wt""",
)
def b1(spark, sf):
    return b.dataset_sizes(_weights(spark, sf, 0.3), _n(spark, sf), have="size")


@query("b2_blend_exact", f"with recursive {EXACT} select * from ex")
def b2(spark, sf):
    return b.blend_exact(spark, _weights(spark, sf, 0.3), 3 * _n(spark, sf), block=400, warm_up=50)


@query("b3_blend_scalable", f"with {weights_sql(0.3)}, {scalable_sql(f'3 * {N_SQL}')} select * from bl")
def b3(spark, sf):
    return b.blend_scalable(_weights(spark, sf, 0.3), 3 * _n(spark, sf), width=500)


def _samples(spark, sf, weights):
    """Documents of each dataset in shuffled order."""
    docs = table(spark, sf, "documents", "doc_id", "lang").withColumnRenamed("lang", "dataset")
    named = docs.join(F.broadcast(weights.select("dataset", "dataset_id")), "dataset")  # one row per language
    return hash_rank(named, ["doc_id"], 1234, "dataset_sample_id", ("dataset_id",))


SHUFFLED = """sm as (select doc_id, dataset, dataset_id, row_number() over (partition by lang order by md5('1234:' || doc_id), doc_id) - 1
    as dataset_sample_id from documents join wt on wt.dataset = documents.lang)"""


@query(
    "b4_blend_samples",
    f"""with {weights_sql(0.3)}, {scalable_sql(N_SQL)}, {SHUFFLED}
    select bl.position, bl.dataset_id, sm.dataset, sm.dataset_sample_id, sm.doc_id
    from bl join wt using (dataset_id) join sm on sm.dataset_id = bl.dataset_id and sm.dataset_sample_id = bl.dataset_sample_id % wt.size""",
)
def b4(spark, sf):
    w = _weights(spark, sf, 0.3)
    return b.blend_samples(b.blend_scalable(w, _n(spark, sf), 500), _samples(spark, sf, w), w)


@query(
    "b5_blend_drift",
    f"""with {weights_sql(0.3)}, {scalable_sql(f'3 * {N_SQL}')}
    select position // 32 as batch, dataset_id, count(*) as n, max(dataset_sample_id) + 1 as running,
           round(count(*) / 32::double, 6) as batch_share,
           round(max(dataset_sample_id) + 1 - any_value(weight) * (position // 32 + 1) * 32, 6) as drift
    from bl join wt using (dataset_id) group by position // 32, dataset_id""",
)
def b5(spark, sf):
    w = _weights(spark, sf, 0.3)
    out = b.blend_drift(b.blend_scalable(w, 3 * _n(spark, sf), 500), w, 32)
    return out.withColumns({"batch_share": r6("batch_share"), "drift": r6("drift")})


def _plan(spark, sf):
    return b.blend_scalable(_weights(spark, sf, 0.3), _n(spark, sf), 500)


RANKS = f"""with {weights_sql(0.3)}, {scalable_sql(N_SQL)}
  select position, dataset_id, dataset_sample_id, (position - {{c}}) // 24 as batch, (((position - {{c}}) % 24) // 4)::int as rank,
         ((position - {{c}}) % 4)::int as slot
  from bl where position >= {{c}} and position < {{c}} + ({N_SQL} - {{c}}) // 24 * 24"""


@query("b6_assign_ranks", RANKS.format(c=0))
def b6(spark, sf):
    return b.assign_ranks(_plan(spark, sf), _n(spark, sf), 0, 4, 6)


@query(
    "b7_assign_ranks_random",
    f"""with {weights_sql(0.3)}, {scalable_sql(N_SQL)}, k as (select {N_SQL} // 24 * 4 as bucket),
    r as (select bl.*, (position // bucket)::int as rank from bl, k where position < bucket * 6),
    d as (select *, row_number() over (partition by rank order by md5('3:' || position), position) - 1 as draw from r)
    select *, draw // 4 as batch from d""",
)
def b7(spark, sf):
    return b.assign_ranks_random(_plan(spark, sf), _n(spark, sf), 3, 4, 6)


@query(
    "b7_assign_ranks_shared",
    f"""with {weights_sql(0.3)}, {scalable_sql(N_SQL)},
    p as (select *, row_number() over (order by md5('3:' || position), position) - 1 as p from bl where position < {N_SQL} // 24 * 24)
    select position, dataset_id, dataset_sample_id, (p % 6)::int as rank, p // 6 as draw, p // 6 // 4 as batch from p""",
)
def b7_shared(spark, sf):
    return b.assign_ranks_random(_plan(spark, sf), _n(spark, sf), 3, 4, 6, data_sharding=False)


def permuted_sql(seed: int) -> str:
    """CTEs ending in perm(x, p): where the permutation of [0, n) puts x, n being the number of documents."""
    net = "select x, l0 // b as l, l0 % b as r, n, a, b from (select x, y as l0, n, a, b from {source} cross join ab)"
    for k, (m, c, d) in enumerate(pm.keys(seed)):
        of, to, below = ("r", "l", "a") if k % 2 == 0 else ("l", "r", "b")
        net = f"select *, ({of} * {m} + {c}) % {pm.PRIME} as t from ({net})"
        net = f"select x, {of}, ({to} + ((t * t + {d}) % {pm.PRIME}) % {below}) % {below} as {to}, n, a, b from ({net})"
    net = f"select x, l * b + r as y, n from ({net})"
    return f"""nn as (select count(*)::bigint as n from documents),
    cand as (select n, unnest(range(floor(sqrt(n))::bigint, floor(sqrt(n))::bigint + {pm.CHOICES})) as a from nn),
    ab as (select n, a, (n + a - 1) // a as b from cand order by (n + a - 1) // a * a - n, a limit 1),
    ids as (select unnest(range(0, n)) as x from nn),
    walk as ({net.format(source='(select x, x as y from ids)')} union all {net.format(source='(select x, y from walk where y >= n)')}),
    perm as (select x, y as p from walk where y < n)"""


@query("n4_permuted_order", f"with recursive {permuted_sql(7)} select x as sample_id, p as position from perm")
def n4_permuted(spark, sf):
    n = table(spark, sf, "documents", "doc_id").count()
    return spark.range(n).select(F.col("id").alias("sample_id"), pm.permute(F.col("id"), n, 7).alias("position"))


@query(
    "b7_ranks_by_permutation",
    f"with recursive {permuted_sql(11)} select (x % 6)::int as rank, x // 6 as draw, p as sample_id from perm",
)
def b7_permuted(spark, sf):
    """Every rank computes its own draws; nothing is sorted or exchanged."""
    n = table(spark, sf, "documents", "doc_id").count()
    rank, draw = (F.col("id") % 6).cast("int"), F.call_function("div", F.col("id"), F.lit(6).cast("long"))
    return spark.range(n).select(rank.alias("rank"), draw.alias("draw"), pm.permute(F.col("id"), n, 11).alias("sample_id"))


@query("b8_resume", RANKS.format(c=240))
def b8(spark, sf):
    return b.resume(_plan(spark, sf), _n(spark, sf), b.consumed_samples(10, 0, 24), 4, 6)


@query(
    "b9_stage_plan",
    f"""with {weights_sql(0.3, 'w1')}, {weights_sql(1.0, 'w2')}, {scalable_sql(N_SQL, 'w1', 'p1')},
    {scalable_sql(f'2 * {N_SQL}', 'w2', 'p2')},
    a as (select 'broad' as stage, position, position as stage_position, dataset_id, dataset_sample_id from p1
          union all select 'late', position + {N_SQL}, position, dataset_id, dataset_sample_id from p2)
    select a.stage, a.position, a.stage_position, a.dataset_id, a.dataset_sample_id % size as dataset_sample_id,
           a.dataset_sample_id // size as dataset_epoch
    from a join w1 using (dataset_id)""",
)
def b9(spark, sf):
    n = _n(spark, sf)
    first, second = _weights(spark, sf, 0.3), _weights(spark, sf, 1.0)
    return b.stage_plan([("broad", n, first), ("late", 2 * n, second)], 500, first)
