"""Registered queries against their SQL in DuckDB, and the shape of their plans.

All queries run; FEW_QUERIES=1 keeps one of every kind.
"""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from corpusloom import plans
from tools.check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
CORE = """x1_html_to_text x5_drop_symbol_lines l2_detect_lang d1_exact_dedup d6_dup_clusters d7_line_dedup f1_gopher
f12_per_lang_thresholds f13_filter_report t1_toxic_density t5_audit_sample q6_quality_buckets p2_redact_pii s6_merge_shards
k3_tokenize k10_verify_merge_index n2_document_order n5_materialize_samples b2_blend_exact b3_blend_scalable m2_unimax
m8_tail_to_head c2_upsample_long a3_rolling_throughput a6_domain_collapse""".split()
SQL = entry.oracle_sql()
NAMES = CORE if os.environ.get("FEW_QUERIES") else sorted(plans.SQL)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cur = duck.execute(SQL[name])
    cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, cur.fetchall())


def test_contract(spark):
    queries = entry.queries()
    assert set(SQL) <= set(queries)
    own = set(plans.QUERIES)
    assert own <= set(queries) and own - set(SQL) == {
        "c4_pack_whole", "d8_semantic_dedup_kmeans", "k2_train_bpe", "k3_bpe_tokenize", "m12_regmix", "q3_quality_classifier", "t4_toxicity_classifier"}
    df = entry.entry(spark)
    assert df.columns == ["lang", "source", "n_docs", "n_sequences", "n_tokens"] and df.count() > 0


def _plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


@pytest.mark.parametrize("name", ["f1_gopher", "p2_redact_pii", "t1_toxic_density", "x5_drop_symbol_lines", "f10_repetition"])
def test_row_local_queries_have_no_join_or_aggregate(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    assert "Exchange" not in plan and "Aggregate" not in plan and "Join" not in plan and "Python" not in plan


@pytest.mark.parametrize("name", ["n5_materialize_samples", "b3_blend_scalable", "m8_tail_to_head", "d5_verify_jaccard"])
def test_no_nested_loop_joins(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(entry.queries()["s4_pending_inputs"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan and "text" not in plan


@pytest.mark.parametrize(
    "name", ["f12_per_lang_thresholds", "f13_filter_report", "l4_min_confidence", "p4_pii_report", "q7_curated_share", "k6_count_tokens"])
def test_texts_are_never_dealt_by_language_or_source(spark, name):
    known = [q for q in entry.queries() if q.startswith(name.split("_")[0] + "_")]
    for q in known:
        plan = _plan(entry.queries()[q](spark, SF))
        # Narrow rows may be dealt by (lang, bucket) and the like; nothing is dealt on demand of a reader.
        assert "REPARTITION" not in plan, q
