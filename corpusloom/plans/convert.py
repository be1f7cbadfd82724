"""Reading, tokenising, merging and verification queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.ordering import range_rank
from corpusloom.operators import bpe, dedup, filters, sentences
from corpusloom.operators import tokens as k
from corpusloom.plans.filtering import GOPHER
from corpusloom.plans.registry import query, r6, table
from corpusloom.session import materialize, stage_path
from corpusloom.sources import io

VOCAB = 2000
KEY = r"md5(trim(regexp_replace(lower(text), '[ \t\r\n\f]+', ' ', 'g'), ' '))"
PIECES = r"regexp_extract_all(text, ' ?[^ \t\n\r\f]+|[ \t\n\r\f]')"


def vocab_sql(docs: str = "documents") -> str:
    return f"""voc as (select token, n, (256 + row_number() over (order by n desc, token))::int as id
               from (select unnest({PIECES}) as token, count(*) as n from {docs} group by 1)
               order by n desc, token limit {VOCAB})"""


def tok_sql(docs: str = "documents") -> str:
    """CTEs ending in tok(doc_id, j, b, id): ids in order (j, b), the end-of-document id last."""
    return f"""{vocab_sql()},
  pc as (select doc_id, unnest({PIECES}) as token, generate_subscripts({PIECES}, 1) as j from {docs}),
  enc as (select doc_id, j, id, token from pc left join voc using (token)),
  tok as (select doc_id, j, 0 as b, id from enc where id is not null
          union all
          select doc_id, j, b, ('0x' || substr(hx, 2 * b + 1, 2))::int + 1 from (
            select doc_id, j, hx, unnest(range(0, length(hx) // 2)) as b
            from (select doc_id, j, hex(encode(token)) as hx from enc where id is null))
          union all select doc_id, max(j) + 1, 0, 0 from pc group by 1)"""


def docs_of(spark, sf, *cols):
    return table(spark, sf, "documents", "doc_id", *cols, "text")


def vocab_of(spark, sf):
    return materialize(k.train_vocab(docs_of(spark, sf), VOCAB), "vocab")


def tokens_of(spark, sf, *cols):
    """The token table, written once as the conversion stage does."""
    tok = k.tokenize(docs_of(spark, sf, *cols), vocab_of(spark, sf)).drop("text")
    return materialize(tok, "tokens")


def _shards(spark, sf):
    """Token rows per source shard with a dense local id in document order."""
    tok = tokens_of(spark, sf, "source").withColumnRenamed("source", "shard")
    return range_rank(tok.drop("tokens", "sentence_lens"), [F.col("doc_id")], "local_id", ("shard",))


SHARD_SQL = f"""{tok_sql()},
  nt as (select d.doc_id, source as shard, count(tok.id)::int as n_tokens
         from documents d left join tok using (doc_id) group by 1, 2),
  shard as (select *, row_number() over (partition by shard order by doc_id) - 1 as local_id from nt)"""


@query(
    "flagship_curate_and_count",
    f"""with recursive {tok_sql()}, {GOPHER},
    keep as (select min(doc_id) as doc_id from documents group by {KEY}),
    good as (select doc_id, lang, source from g join keep using (doc_id) where n_words between 50 and 100000
             and mean_word_len between 3 and 10 and ellipsis_words <= 0.3),
    n as (select good.*, count(id) as n from good left join tok using (doc_id) group by all)
    select lang, source, count(*) as n_docs, count(*) as n_sequences, sum(n)::bigint as n_tokens
    from n group by rollup (lang, source)""",
)
def flagship(spark, sf):
    docs = docs_of(spark, sf, "lang", "source")
    clean = filters.gopher(dedup.exact_dedup(docs)).where("passes").select(*docs.columns)
    return k.count_tokens(k.tokenize(clean, vocab_of(spark, sf)), ["lang", "source"])


# ---- sources -----------------------------------------------------------------------------------
DOC_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("lang", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


def _jsonl(spark, sf):
    """The documents as JSON lines: some languages lose their text key, a share of lines is broken."""
    docs = docs_of(spark, sf, "lang")
    text = F.when(F.col("doc_id") % 50 == 7, F.lit("  ")).when(F.col("doc_id") % 50 != 8, F.col("text"))
    line = F.to_json(F.struct("doc_id", "lang", text.alias("text")))
    path = stage_path(spark, "jsonl")
    broken = F.when(F.col("doc_id") % 50 == 9, F.concat(F.lit('{"doc_id": '), F.col("text"))).otherwise(line)
    # One folder per language, its files in the order of the ids: no language is written by a single task.
    lines = docs.select(F.concat(F.lit("part-"), "lang").alias("part"), "doc_id", F.regexp_replace(broken, "\n", " ").alias("value"))
    ranged = lines.repartitionByRange("part", "doc_id").sortWithinPartitions("part", "doc_id")
    ranged.select("part", "value").write.partitionBy("part").text(path)
    return io.read_jsonl(spark, path, DOC_SCHEMA, in_parts=True)


@query(
    "s1_read_jsonl",
    """select case when doc_id % 50 = 9 then null else doc_id end as doc_id, lang as part_lang,
              case when doc_id % 50 in (8, 9) then null when doc_id % 50 = 7 then '  ' else text end as text,
              doc_id % 50 = 9 as corrupt, dense_rank() over (order by lang)::int as file_index,
              row_number() over (partition by lang order by doc_id) - 1 as line_no from documents""",
)
def s1(spark, sf):
    return _jsonl(spark, sf).select(
        "doc_id",
        F.regexp_extract("part", "part-(.*)", 1).alias("part_lang"),
        "text",
        F.col("_corrupt_record").isNotNull().alias("corrupt"),
        "file_index",
        "line_no",
    )


@query("s2_read_parquet", "select doc_id, text, lang, source, n_chars from documents")
def s2(spark, sf):
    return io.read_parquet(spark, f"{sf}/documents.parquet", "text", "doc_id")


@query(
    "s3_validate_text_key",
    """select count(*) as n_rows, count(*) filter (doc_id % 50 = 8) as n_null,
              count(*) filter (doc_id % 50 = 7 or trim(text, ' ') = '') as n_blank,
              count(*) filter (doc_id % 50 = 9) as n_corrupt,
              count(*) filter (doc_id % 50 not in (7, 8, 9) and trim(text, ' ') <> '') as n_usable from documents""",
)
def s3(spark, sf):
    return io.validate_text_key(_jsonl(spark, sf), "text")


@query(
    "s4_pending_inputs",
    "select doc_id, source from documents where doc_id not in (select doc_id from labels)",
)
def s4(spark, sf):
    # Labelled documents stand for inputs that a manifest lists as converted.
    return io.pending(table(spark, sf, "documents", "doc_id", "source"), table(spark, sf, "labels", "doc_id"), "doc_id")


@query(
    "s5_write_tokens",
    f"""with {tok_sql()}, t as (select doc_id, string_agg(id::varchar, ' ' order by j, b) as ids, count(*)::int as n from tok group by 1)
    select doc_id, lang as dataset, coalesce(n, 0) as n_tokens, md5(coalesce(ids, '')) as tokens_md5
    from documents left join t using (doc_id)""",
)
def s5(spark, sf):
    tok = tokens_of(spark, sf, "lang").withColumnRenamed("lang", "dataset")
    path = stage_path(spark, "token-table")
    io.write_tokens(tok.select("dataset", "doc_id", "tokens", "n_tokens"), path)
    back = spark.read.parquet(path)
    return back.select("doc_id", "dataset", "n_tokens", F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


@query(
    "s6_merge_shards",
    """select source as shard, doc_id, row_number() over (partition by source order by doc_id) - 1 as local_id,
              row_number() over (order by regexp_extract(source, '[0-9]+')::int, doc_id) - 1 as global_id,
              row_number() over (order by source, doc_id) - 1 as lexical_id from documents""",
)
def s6(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "source").withColumnRenamed("source", "shard")
    local = range_rank(docs, [F.col("doc_id")], "local_id", ("shard",))
    merged = io.merge_shards(local, "shard", "local_id", io.numeric_suffix("shard"), 20)
    return io.merge_shards(merged, "shard", "local_id", F.col("shard"), 20, "lexical_id")


# ---- tokens ------------------------------------------------------------------------------------
@query(
    "k1_split_sentences",
    r"""with s as (select doc_id, list_filter(list_transform(regexp_extract_all(text, '(?s).+?(?:[.!?]+(?:\s+|\z)|\z)'),
          lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') as ss from documents)
    select doc_id, unnest(range(0, len(ss)))::int as seq_no, unnest(ss) as sentence from s""",
)
def k1(spark, sf):
    return docs_of(spark, sf).select("doc_id", F.posexplode(k.split_sentences("text")).alias("seq_no", "sentence"))


@query(
    "k1_split_keep_newlines",
    r"""select doc_id, len(regexp_extract_all(text, '(?s).+?(?:[.!?]+(?:\s+|\z)|\z)'))::int as n_sentences, text
        from documents""",
)
def k1_keep(spark, sf):
    return docs_of(spark, sf).withColumn("s", k.split_sentences("text", keep_newlines=True)).select(
        "doc_id", F.size("s").alias("n_sentences"), F.array_join("s", "").alias("text")
    )


def _core_sql(piece: str) -> str:
    return rf"""regexp_replace({piece}, '^[ \t\n\r\f"''(\[{{«“„‘]+|[ \t\n\r\f"'')\]}}»”’,;:]+\z', '', 'g')"""


def _type_sql(word: str) -> str:
    bare = rf"lower(regexp_replace({word}, '\.\z', ''))"
    return rf"case when regexp_matches({bare}, '^[0-9]([0-9.,]*[0-9])?\z') then '##' else {bare} end"


def _ratio_sql(a: str, b: str, ab: str, n: str) -> str:
    def xlogy(x, p):
        return f"case when ({x}) = 0 or ({p}) <= 0 then 0.0::double else ({x}) * ln({p}) end"

    p, p1, p2 = f"({b})::double / {n}", f"({ab})::double / {a}", f"coalesce(({b} - {ab})::double / nullif({n} - {a}, 0), 0)"
    apart = [xlogy(ab, p), xlogy(f"{a} - {ab}", f"1 - {p}"), xlogy(f"{b} - {ab}", p), xlogy(f"{n} - {a} - {b} + {ab}", f"1 - {p}")]
    joint = [xlogy(ab, p1), xlogy(f"{a} - {ab}", f"1 - {p1}"), xlogy(f"{b} - {ab}", p2), xlogy(f"{n} - {a} - {b} + {ab}", f"1 - {p2}")]
    return f"2 * ({' + '.join(joint)} - ({' + '.join(apart)}))"


BOUNDARY_SQL = rf"""
  pc as materialized (select doc_id, lang, regexp_extract_all(text, '[ 	

]*[^ 	

]+[ 	

]*') as ps from documents),
  cw as materialized (select doc_id, lang, ps, list_transform(ps, lambda x: {_core_sql('x')}) as ws from pc),
  pr as (select lang, unnest(ws) as a, unnest(list_concat(ws[2:], [''])) as b from cw where len(ws) > 0 and lang is not null),
  pairs as materialized (select lang, a, b, count(*)::bigint as n, {_type_sql('a')} as t, regexp_matches(a, '[^.]\.\z') as stop from pr group by 1, 2, 3),
  types as materialized (select lang, t as type, coalesce(sum(n) filter (stop), 0)::bigint as n_stop, coalesce(sum(n) filter (not stop), 0)::bigint as n_plain
    from pairs group by 1, 2),
  whole as materialized (select lang, sum(n_stop + n_plain)::bigint as nn, sum(n_stop)::bigint as stops from types group by 1),
  sz as (select *, stops::double / nn as p, length(regexp_replace(type, '[^.]', '', 'g')) as inside from types join whole using (lang)
    where n_stop > 0 and regexp_matches(type, '\p{{L}}') and stops < nn),
  ab as materialized (select *, lang || '/' || type as k from (
    select lang, type, 2 * (n_stop * ln(0.99 / p) + n_plain * ln((1 - 0.99) / (1 - p))) * exp(-(length(type) - inside)) * (inside + 1)
    * pow((length(type) - inside)::double, -n_plain) as score from sz) where score >= 0.3),
  mk as materialized (select lang, a, b, n, t, u, lang || '/' || t as tk, lang || '/' || u as uk, case when regexp_matches(t, '^\p{{L}}\z') then 'initial'
    when lang || '/' || t in (select k from ab) then 'abbreviation' when t = '##' then 'number' else 'plain' end as sort
    from (select lang, a, b, n, t, {_type_sql('b')} as u from pairs where stop and b <> '')),
  tot as materialized (select lang || '/' || type as k, n_stop + n_plain as nb from types),
  ends as materialized (select lang, sum(n) as na, any_value(nn) as nn from mk join whole using (lang) where sort = 'plain' group by 1),
  fst as materialized (select lang, u as type, uk, sum(n) as nab from mk where sort = 'plain' group by 1, 2, 3),
  st as materialized (select lang, type, uk, score from (select f.lang, type, uk, nb, nab, na, nn, {_ratio_sql('na', 'nb', 'nab', 'nn')} as score
    from fst f join tot on tot.k = f.uk join ends on ends.lang = f.lang) where nab::double / nb > na::double / nn and score >= 30),
  bo as materialized (select lang, t, u, tk, uk, sum(n) as nab from mk where sort <> 'plain' group by all having sum(n) > 1),
  bx as materialized (select bo.*, nb as na from bo join tot on tot.k = tk),
  by_ as materialized (select bx.*, nb from bx join tot on tot.k = uk),
  co as materialized (select lang, t, u, tk || '/' || u as k, score from (select by_.*, nn, {_ratio_sql('na', 'nb', 'nab', 'nn')} as score
    from by_ join whole using (lang)) where nab::double / nb > na::double / nn and score >= 7.88 and uk not in (select uk from st)),
  shp as materialized (select lang || '/' || u as k, bool_or(low) as low, bool_or(inside) as inside from (
    select lang, {_type_sql('b')} as u, regexp_matches(b, '^\p{{Ll}}') as low,
      regexp_matches(b, '^\p{{Lu}}') and not regexp_matches(a, '[.!?]\z') as inside from pairs where b <> '') group by 1),
  dec as materialized (select lang || '/' || a || ' ' || b as k, case when sort = 'plain' then true when tk || '/' || u in (select k from co) then false
    when sort = 'abbreviation' then regexp_matches(b, '^\p{{Lu}}') and ((low and not inside) or uk in (select uk from st))
    when sort = 'initial' then regexp_matches(b, '^\p{{Lu}}') and low and not inside
    else not regexp_matches(b, '^\p{{Ll}}') end as breaks from mk left join shp on shp.k = uk)"""


def _boundaries(spark, sf):
    return sentences.train(docs_of(spark, sf, "lang"))


@query(
    "k1_sentence_model",
    f"""with {BOUNDARY_SQL} select lang, 'abbreviation' as kind, type as a, null::varchar as b, round(score, 6) as score from ab
        union all select lang, 'starter', type, null, round(score, 6) from st union all select lang, 'pair', t, u, round(score, 6) from co""",
)
def k1_model(spark, sf):
    return _boundaries(spark, sf)[0].withColumn("score", r6("score"))


@query(
    "k1_split_by_language",
    rf"""with {BOUNDARY_SQL},
    cand as (select doc_id, lang, unnest(range(1, len(ws))) as i, ws from cw where len(ws) > 1),
    kept as (select doc_id, list(i) as held from cand join dec on dec.k = lang || '/' || ws[i] || ' ' || ws[i + 1]
      where regexp_matches(ws[i], '[^.]\.\z') and not breaks group by 1),
    cuts as (select cw.doc_id, ps, list_concat([0], list_filter(range(1, len(ws)), lambda i: not list_contains(coalesce(held, []), i) and (
        regexp_matches(ws[i], '[!?]\z') or regexp_matches(ws[i], '[^.]\.\z')
        or regexp_matches(ws[i], '\.\.\z') and regexp_matches(ws[i + 1], '^\p{{Lu}}'))), [len(ws)]) as e
      from cw left join kept using (doc_id) where len(ws) > 0)
    select doc_id, (k - 1)::int as seq_no, array_to_string(ps[e[k] + 1 : e[k + 1]], '') as sentence
    from (select *, unnest(range(1, len(e))) as k from cuts)""",
)
def k1_by_language(spark, sf):
    docs = docs_of(spark, sf, "lang")
    out = sentences.split(docs, _boundaries(spark, sf)[1])
    return out.select("doc_id", F.posexplode("sentences").alias("seq_no", "sentence"))


BPE_MERGES = 300


def _merges(spark, sf):
    return bpe.train(docs_of(spark, sf), BPE_MERGES)


@query("k2_train_bpe")
def k2_bpe(spark, sf):
    return _merges(spark, sf)


@query("k3_bpe_tokenize")
def k3_bpe(spark, sf):
    tok = bpe.tokenize(docs_of(spark, sf), _merges(spark, sf))
    return tok.select("doc_id", "n_tokens", F.md5(F.array_join("tokens", " ")).alias("ids_md5"))


@query("k8_bpe_roundtrip", "select doc_id, md5(text) as text_md5, octet_length(encode(text))::bigint as n_bytes from documents")
def k8_bpe(spark, sf):
    merges = _merges(spark, sf)
    back = bpe.detokenize(bpe.tokenize(docs_of(spark, sf), merges), merges)
    return back.select("doc_id", F.md5("text").alias("text_md5"), F.octet_length("text").cast("long").alias("n_bytes"))


@query("k2_train_vocab", f"with {vocab_sql()} select token, n, id from voc")
def k2(spark, sf):
    return vocab_of(spark, sf)


@query(
    "k3_tokenize",
    f"""with {tok_sql()} select doc_id, string_agg(id::varchar, ' ' order by j, b) as tokens, count(*)::int as n_tokens,
        count(*)::varchar as sentence_lens from tok group by 1""",
)
def k3(spark, sf):
    return tokens_of(spark, sf).where("n_tokens > 0").select(
        "doc_id",
        F.array_join("tokens", " ").alias("tokens"),
        "n_tokens",
        F.array_join("sentence_lens", " ").alias("sentence_lens"),
    )


@query(
    "k3_tokenize_sentences",
    rf"""with recursive {vocab_sql()},
    s as (select doc_id, unnest(range(0, len(ss))) as seq_no, unnest(ss) as text from (
            select doc_id, list_filter(list_transform(regexp_extract_all(text, '(?s).+?(?:[.!?]+(?:\s+|\z)|\z)'),
              lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') as ss from documents)),
    p as (select doc_id, seq_no, unnest({PIECES}) as token from s),
    n as (select doc_id, seq_no, sum(case when id is null then octet_length(encode(token)) else 1 end)::int as n
          from p left join voc using (token) group by 1, 2),
    e as (select doc_id, seq_no, n + (seq_no = max(seq_no) over (partition by doc_id))::int as n from n)
    select doc_id, count(*)::int as n_sequences, sum(n)::int as n_tokens,
           string_agg(n::varchar, ' ' order by seq_no) as sentence_lens from e group by 1""",
)
def k3_sentences(spark, sf):
    tok = k.tokenize(docs_of(spark, sf), vocab_of(spark, sf), sentences=True).where("n_tokens > 0")
    return tok.select(
        "doc_id",
        F.size("sentence_lens").alias("n_sequences"),
        "n_tokens",
        F.array_join("sentence_lens", " ").alias("sentence_lens"),
    )


@query(
    "k4_chunk_long",
    """with c as (select doc_id, unnest(range(0, (length(text) - 1) // 2000 + 1))::int as chunk_no, text from documents
                  where length(text) > 0)
    select doc_id, chunk_no, substr(text, chunk_no * 2000 + 1, 2000) as text from c
    where length(trim(substr(text, chunk_no * 2000 + 1, 2000), ' ')) > 0""",
)
def k4(spark, sf):
    return k.chunk_long(docs_of(spark, sf), 2000)


@query(
    "k5_count_tokens",
    f"""with {tok_sql()}, n as (select lang, source, d.doc_id, count(id) as n from documents d left join tok using (doc_id) group by all)
    select lang, source, count(*) as n_docs, sum((n > 0)::int)::bigint as n_sequences, sum(n)::bigint as n_tokens
    from n group by rollup (lang, source)""",
)
def k5(spark, sf):
    return k.count_tokens(tokens_of(spark, sf, "lang", "source"), ["lang", "source"])


@query(
    "k6_verify_nonempty",
    f"""with {SHARD_SQL}, f as (select shard, count(*) as n_docs, sum(n_tokens)::bigint as n_tokens from shard
          where shard <> 'src3' group by 1), e as (select distinct source as shard from documents where source <> 'src5')
    select coalesce(f.shard, e.shard) as shard, coalesce(n_docs, 0) as n_docs, coalesce(n_tokens, 0) as n_tokens,
           case when e.shard is null then 'unexpected' when n_docs is null then 'missing' else 'ok' end as status
    from f full join e on f.shard = e.shard""",
)
def k6(spark, sf):
    # One shard is left out on each side to exercise both kinds of failure.
    expected = table(spark, sf, "documents", "source").where("source <> 'src5'").withColumnRenamed("source", "shard")
    return k.verify_nonempty(_shards(spark, sf).where("shard <> 'src3'"), expected)


@query(
    "k7_verify_counts",
    """with d as (select lang as file_name, count(*) as n_lines, count(*) filter (doc_id % 50 = 8) as n_null,
              count(*) filter (doc_id % 50 = 7) as n_blank, count(*) filter (doc_id % 50 = 9) as n_corrupt from documents group by 1),
    c as (select lang as file_name, sum(n)::bigint as n_docs, sum(n - 1)::bigint as n_chunked from (
             select lang, (length(text) - 1) // 5000 + 1 as n from documents
             where doc_id % 50 not in (7, 8, 9)) group by 1)
    select file_name, n_lines, n_null, n_blank, n_corrupt, n_docs, n_chunked, n_docs - n_lines as gap,
           case when n_docs = n_lines then 'ok' when n_docs - n_lines = n_chunked - n_null - n_blank - n_corrupt
                then 'explained' else 'mismatch' end as status from d join c using (file_name)""",
)
def k7(spark, sf):
    raw = _jsonl(spark, sf).withColumn("file_name", F.regexp_extract("part", "part-(.*)", 1))
    usable = k.chunk_long(raw.where("text is not null and length(trim(text)) > 0"), 5000)
    return k.verify_counts(raw, k.tokenize(usable, vocab_of(spark, sf)))


@query("k8_verify_roundtrip", "select doc_id, true as matches from documents")
def k8(spark, sf):
    docs, vocab = docs_of(spark, sf), vocab_of(spark, sf)
    return k.verify_roundtrip(docs, k.tokenize(docs, vocab).drop("text"), vocab)


@query(
    "k9_verify_merge_totals",
    f"""with {SHARD_SQL}, t as (select count(*) as merged_docs, sum(n_tokens)::bigint as merged_tokens from shard)
    select shard, count(*) as n_docs, sum(n_tokens)::bigint as n_tokens, any_value(merged_docs) as merged_docs,
           any_value(merged_tokens) as merged_tokens, case when shard is null then true end as tally
    from shard, t group by rollup (shard)""",
)
def k9(spark, sf):
    shards = _shards(spark, sf).select("shard", "local_id", "n_tokens")
    merged = materialize(io.merge_shards(shards, "shard", "local_id", io.numeric_suffix("shard"), 20), "merged")
    return k.verify_merge_totals(shards, merged)


@query(
    "k10_verify_merge_index",
    f"""with {SHARD_SQL}, x as (select *, row_number() over (order by regexp_extract(shard, '[0-9]+')::int, local_id) - 1 as num,
              row_number() over (order by shard, local_id) - 1 as lex from shard)
    select a.num as global_id, a.shard, a.local_id, a.n_tokens as want, b.n_tokens as got
    from x a join x b on a.num = b.lex where a.n_tokens <> b.n_tokens""",
)
def k10(spark, sf):
    # Merged in name order but checked against numeric order: every misplaced length must show.
    shards = _shards(spark, sf).select("shard", "local_id", "n_tokens")
    merged = io.merge_shards(shards, "shard", "local_id", F.col("shard"), 20)
    wrong = k.verify_merge_index(shards, merged, io.numeric_suffix("shard"))
    return wrong.withColumnsRenamed({"_want": "want", "_got": "got"})


@query(
    "k10_verify_merge_index_clean",
    "select count(*) as n_docs, 0::bigint as n_wrong from documents",
)
def k10_clean(spark, sf):
    shards = _shards(spark, sf).select("shard", "local_id", "n_tokens")
    merged = io.merge_shards(shards, "shard", "local_id", io.numeric_suffix("shard"), 20)
    wrong = k.verify_merge_index(shards, merged, io.numeric_suffix("shard")).agg(F.count("*")).scalar()
    return shards.agg(F.count("*").alias("n_docs")).withColumn("n_wrong", wrong)


@query(
    "k11_doc_offsets",
    f"""with {SHARD_SQL} select doc_id, n_tokens, (sum(n_tokens) over (order by doc_id) - n_tokens)::bigint as element_offset,
        (4 * (sum(n_tokens) over (order by doc_id) - n_tokens))::bigint as byte_offset from nt""",
)
def k11(spark, sf):
    return k.doc_offsets(tokens_of(spark, sf))
