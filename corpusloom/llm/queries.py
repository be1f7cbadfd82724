"""Registered queries of this subpackage and, where SQL can express them, their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import alignment, decontaminate, extract, fingerprint, line_quality, packing, privacy, sharding, similar, spelling, substring_dedup, suffix_dedup, toxicity
from corpusloom.llm.common import read, small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def bounded(spark: SparkSession, sf: str) -> DataFrame:
            small_batches(spark)
            return fn(spark, sf)

        QUERIES[name] = bounded
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op3_fingerprints")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprint.compare_with_next(read(spark, sf, "documents"))


@query("op4_sharding")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    out = sharding.assign(read(spark, sf, "documents"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op1_toxicity")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.judge(read(spark, sf, "documents"), read(spark, sf, "labels"))


OP2_SQL = r"""
with w as (
    select row_number() over () as id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), starts as (
    select id, unnest(range(1, len(words) - 35 + 2)) as p from w where len(words) >= 35
), windows as (
    select s.id, s.p, md5(array_to_string(w.words[s.p : s.p + 34], ' ')) as h from starts s join w using (id)
), dup as (
    select id, p from windows qualify count(*) over (partition by h) > 1
), gone as (
    select distinct id, unnest(range(p, p + 35)) as k from dup
), marks as (
    select id, list(k) as ks, count(*) as n from gone group by id
), kept as (
    select w.id, w.doc_id, w.words, coalesce(m.n, 0) as n_removed, coalesce(m.ks, []) as ks from w left join marks m using (id)
), numbered as (
    select id, doc_id, words, n_removed, list_filter(range(1, len(words) + 1), lambda k: not list_contains(ks, k)) as keep from kept
)
select doc_id, len(words)::bigint as n_words, n_removed::bigint as n_removed,
    sha256(array_to_string(list_transform(keep, lambda k: words[k]), ' ')) as kept_sha256
from numbered
"""


@query("op2_substring_dedup", OP2_SQL)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup.remove_repeats(read(spark, sf, "documents"))


OP5_SQL = r"""
with b as (
    select row_number() over () as id, doc_id, hex(encode(coalesce(text, ''))) as x, octet_length(encode(coalesce(text, '')))::bigint as n from documents
), starts as (
    select id, doc_id, unnest(range(0, n - 50 + 1)) as p from b where n >= 50
), strings as (
    select s.id, s.doc_id, s.p, md5_number_lower(substr(b.x, 2 * s.p + 1, 100)) as h from starts s join b using (id)
), later as (
    select id, p from strings qualify min(doc_id) over (partition by h) < doc_id
), islands as (
    select id, p, sum(fresh) over (partition by id order by p) as g from (
        select id, p, case when p <= lag(p) over (partition by id order by p) + 50 then 0 else 1 end as fresh from later
    )
), spans as (
    select id, min(p) as lo, max(p) + 50 as hi from islands group by id, g
), cuts as (
    select id, list(struct_pack(lo := lo, hi := hi) order by lo) as l, sum(hi - lo) as gone, count(*) as n_spans from spans group by id
), full_docs as (
    select b.*, coalesce(l, []) as l, coalesce(gone, 0) as gone, coalesce(n_spans, 0) as n_spans from b left join cuts using (id)
)
select doc_id, n as n_bytes, gone::bigint as n_removed, n_spans::bigint as n_spans, sha256(unhex(
    array_to_string(list_transform(range(0, len(l) + 1), lambda k: substr(
        x, 2 * (case when k = 0 then 0 else l[k].hi end) + 1,
        2 * ((case when k = len(l) then n else l[k + 1].lo end) - (case when k = 0 then 0 else l[k].hi end)))), '')
)) as kept_sha256
from full_docs
"""


@query("op5_suffix_dedup", OP5_SQL)
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.remove_later_copies(read(spark, sf, "documents"))


@query("op6_html_extraction")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return extract.main_text(read(spark, sf, "pages"))


OP7_SQL = r"""
with recursive t as (
    select coalesce(text, '') as text, min(doc_id) as id, count(*)::bigint as n_copies from documents group by 1
), w as (
    select id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words from t
), s as (
    select distinct id, unnest(case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
        else list_transform(range(1, len(words) - 3), lambda k: array_to_string(words[k : k + 4], ' ')) end) as g from w
), size as (
    select id, count(*) as n from s group by id
), common as (
    select a.id as x, b.id as y, count(*) as c from s a join s b on a.g = b.g and a.id <> b.id group by 1, 2
), link as (
    select x, y from common join size p on p.id = x join size q on q.id = y where c::double / (p.n + q.n - c) >= 0.8
), reach as (
    select x as id, x as r from link
    union
    select r.id, link.y from reach r join link on link.x = r.r
), class as (
    select id, min(r) as class_id from reach group by id
), degree as (
    select x as id, count(*)::bigint as n_links from link group by x
)
select d.doc_id, coalesce(class_id, t.id) as class_id, coalesce(n_links, 0)::bigint as n_links, n_copies
from documents d join t on t.text = coalesce(d.text, '') left join class on class.id = t.id left join degree on degree.id = t.id
"""


@query("op7_jaccard_join", OP7_SQL)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return similar.similar(read(spark, sf, "documents"))


@query("op8_decontamination")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


@query("op9_packing")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return packing.best_fit_pack(read(spark, sf, "documents"), tokenizer_path())


@query("op10_personal_data")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return privacy.report(read(spark, sf, "documents"))


# The checksum is taken byte by byte through its table of 256 entries, once for every run of a document.
OP11_SQL = r"""
with recursive tab as (
    select list(v order by i) as t from (
        select i, list_reduce(list_prepend(i::bigint, range(8)), lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
        from range(256) r(i))
), runs as (
    select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]{6,}')) as run
    from documents
), once as (
    select run, count(*) as c, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as x from runs group by doc_id, run
), checked as (
    select run, c, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
        range(0, len(x) // 2), lambda i: ('0x' || substr(x, (2 * i + 1)::int, 2))::bigint)),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) as k
    from once, tab
), corrupted as (
    select case when k % 199 = 0 then left(run, k % length(run)) || substr(run, k % length(run) + 2) else run end as word, c from checked
), v as (
    select word, sum(c)::bigint as n from corrupted where length(word) >= 6 group by word having sum(c) >= 5
), gone as (
    select word, length(word) as l, i, left(word, i) || substr(word, i + 2) as d from (select word, unnest(range(0, length(word))) as i from v)
), near as (
    select a.word, b.word as other from gone a join gone b on a.d = b.d and a.i = b.i and a.word <> b.word
    union
    select a.word, b.word from gone a join v b on a.d = b.word
    union
    select b.word, a.word from gone a join v b on a.d = b.word
), best as (
    select near.word, count(*)::bigint as n_near, arg_min(other, row(-w.n, other)) as top, max(w.n) as top_n
    from near join v w on w.word = near.other group by 1
), formed as (
    select v.word, v.n, coalesce(n_near, 0)::bigint as n_near, case when top_n >= 5 * n then top end as form, case when top_n >= 5 * n then top_n end as form_n
    from v left join best using (word)
), walk as (
    select word, form as here, 1 as k from formed where form is not null
    union all
    select walk.word, f.form, k + 1 from walk join formed f on f.word = walk.here where f.form is not null
), ends as (
    select word, arg_max(here, k) as root from walk group by word
)
select word, form, coalesce(root, word) as root, n, n_near, form_n::bigint as form_n from formed left join ends using (word)
"""


@query("op11_spelling_variants", OP11_SQL)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(read(spark, sf, "documents"))


@query("op13_tokenizer_alignment")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.align(read(spark, sf, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


@query("op12_line_quality")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return line_quality.judge(read(spark, sf, "documents"), read(spark, sf, "labels"))
