"""Conversion, verification, packing, blending and long-context composition."""

from __future__ import annotations

import random
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
from corpusloom.operators import blending as b
from corpusloom.operators import bpe, language
from corpusloom.operators import longctx as c
from corpusloom.operators import packing as p
from corpusloom.operators import tokens as k
from corpusloom.session import BATCH_BYTES, durable_dir
from corpusloom.sources import io

TEXTS = ["the cat sat. The cat ran!\n", "", "ünïcode 3.14 is  pi\t\r\n😀", "the", "   "]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([*enumerate(TEXTS), (9, None)], "doc_id long, text string")


@pytest.fixture(scope="module")
def vocab(spark, docs):
    return k.train_vocab(docs, 6).cache()


def test_round_trip_is_lossless(spark, docs, vocab):
    tok = k.tokenize(docs, vocab)
    rows = {r.doc_id: r for r in tok.collect()}
    assert sorted(rows) == [0, 1, 2, 3, 4]  # a null text has no document
    assert rows[1].tokens == [] and rows[1].sentence_lens == []  # no end of document for an empty text
    for i, r in rows.items():
        if TEXTS[i]:
            assert r.tokens[-1] == k.EOD and k.EOD not in r.tokens[:-1] and sum(r.sentence_lens) == r.n_tokens
    check = {r.doc_id: r.matches for r in k.verify_roundtrip(docs, tok, vocab).collect()}
    assert check == {0: True, 1: True, 2: True, 3: True, 4: True, 9: False}
    wrong = tok.withColumn("tokens", F.slice("tokens", 2, 100))
    assert not any(r.matches for r in k.verify_roundtrip(docs, wrong, vocab).where("doc_id in (0, 2, 3)").collect())
    part = k.verify_roundtrip(docs, tok, vocab, share=0.5, seed=3)
    assert part.count() < 6 and part.count() == k.verify_roundtrip(docs, tok, vocab, share=0.5, seed=3).count()


def test_sentences(spark, docs, vocab):
    rows = docs.where("text is not null").select(
        "doc_id", k.split_sentences("text").alias("s"), k.split_sentences("text", True).alias("raw"),
        k.split_sentences("text", True, piece=4).alias("small")).collect()
    for r in rows:
        assert "".join(r.raw) == TEXTS[r.doc_id] == "".join(r.small)
    assert rows[0].s == ["the cat sat.", "The cat ran!"] and rows[2].s == ["ünïcode 3.14 is  pi\t\r\n😀"]
    tok = k.tokenize(docs, vocab, sentences=True)
    assert len({r.doc_id: r for r in tok.collect()}[0].sentence_lens) == 2


def test_array_text_skips_empty_sentences(spark, vocab):
    df = spark.createDataFrame([(1, ["the", "", " cat"]), (2, ["", ""])], "doc_id long, text array<string>")
    rows = {r.doc_id: r for r in k.tokenize(df, vocab).collect()}
    assert len(rows[1].sentence_lens) == 2 and sum(rows[1].sentence_lens) == len(rows[1].tokens)
    assert rows[1].tokens[-1] == k.EOD and rows[2].tokens == []
    assert k.EOD not in k.tokenize(df, vocab, append_eod=False).where("doc_id = 1").first().tokens


def test_long_text_becomes_chunks(spark):
    long = "x" * 300_000 + " " * 300_000 + "é" * 5
    df = spark.createDataFrame([(1, long), (2, "short"), (3, "")], "doc_id long, text string")
    got = [(r.doc_id, r.chunk_no, len(r.text)) for r in k.chunk_long(df).orderBy("doc_id", "chunk_no").collect()]
    assert got == [(1, 0, 300_000), (1, 2, 5), (2, 0, 5)]


def test_jsonl_corrupt_missing_blank(spark, tmp_path):
    (tmp_path / "b.jsonl").write_text('{"id": 1, "text": "x"}\n{"id": 2}\n{"id": 3, "text": "  "}\n{broken\n')
    (tmp_path / "a.jsonl").write_text('{"id": 4, "text": "y", "lang": "fr"}\n')
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType())])
    raw = io.read_jsonl(spark, str(tmp_path), schema).cache()
    by_name = {r.file_name: r.file_index for r in raw.collect()}
    assert by_name == {"a.jsonl": 1, "b.jsonl": 2} and raw.where("id = 1").first().lang is None
    r = io.validate_text_key(raw, "text").first()
    assert (r.n_rows, r.n_null, r.n_blank, r.n_corrupt, r.n_usable) == (5, 1, 1, 1, 2)
    with pytest.raises(ValueError, match="available: .*text"):
        io.validate_text_key(raw, "content")
    tok = raw.where("text is not null and trim(text) != ''").withColumn("chunk_no", F.lit(0))
    got = {r.file_name: r for r in k.verify_counts(raw, tok).collect()}
    assert got["a.jsonl"].status == "ok" and (got["b.jsonl"].status, got["b.jsonl"].gap) == ("explained", -3)
    ordered = io.read_jsonl(spark, str(tmp_path), schema, file_order=["b.jsonl", "a.jsonl"])
    assert {r.file_name: r.file_index for r in ordered.collect()} == {"a.jsonl": 2, "b.jsonl": 1}


def test_files_are_their_paths_and_lines_keep_their_order(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType())])
    for d, n in (("x y", 30_000), ("b", 10)):
        (tmp_path / d).mkdir()
        (tmp_path / d / "part-0.json").write_text("".join('{"id": %d}\n%s' % (k, "\n" if k == 4 else "") for k in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = io.read_jsonl(spark, [str(tmp_path / "x y"), str(tmp_path / "b")], schema)
        assert rows.rdd.getNumPartitions() > 4
        got = sorted((r.file_index, r.line_no, r.id) for r in rows.collect())
        assert got == [(1, k + (k > 4), k) for k in range(10)] + [(2, k + (k > 4), k) for k in range(30_000)]
        paths = [str(tmp_path / "x y"), str(tmp_path / "b")]
        again = io.read_jsonl(spark, paths, schema, file_order=["x y/part-0.json", "b/part-0.json"])
        assert sorted((r.file_index, r["count"]) for r in again.groupBy("file_index").count().collect()) == [(1, 30_000), (2, 10)]
        with pytest.raises(ValueError, match="2 of the files"):
            io.read_jsonl(spark, paths, schema, file_order=["part-0.json"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_merge_index_finds_a_wrong_order(spark):
    rows = [("p10", 0, 5), ("p2", 0, 7), ("p2", 1, 8)]
    shards = spark.createDataFrame(rows, "shard string, local_id long, n_tokens int")
    merged = io.merge_shards(shards, "shard", "local_id", io.numeric_suffix("shard"), width=1)
    assert [(r.shard, r.local_id) for r in merged.orderBy("global_id").collect()] == [("p2", 0), ("p2", 1), ("p10", 0)]
    assert k.verify_merge_index(shards, merged, io.numeric_suffix("shard")).count() == 0
    assert k.verify_merge_index(shards, merged, F.col("shard")).count() == 3
    total = k.verify_merge_totals(shards, merged).where("shard is null").first()
    assert total.tally and total.n_tokens == 20


def _loop_index(sizes, seq_len):
    """The boundaries found by walking over the documents."""
    out, doc, offset = [(0, 0)], 0, 0
    total = sum(sizes)
    for _ in range((total - 1) // seq_len):
        left = seq_len + 1
        while left > 0:
            here = sizes[doc] - offset
            left -= here
            if left <= 0:
                offset += left + here - 1
            else:
                doc, offset = doc + 1, 0
        out.append((doc, offset))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sample_index_and_samples_equal_the_walk(spark, seed):
    rng = random.Random(seed)
    sizes = {i: rng.choice([0, 1, 2, 3, 9, 40]) for i in range(25)}
    flat = iter(range(10_000))
    rows = [(i, [next(flat) for _ in range(n)], n) for i, n in sizes.items()]
    tokens = spark.createDataFrame(rows, "doc_id long, tokens array<int>, n_tokens int")
    placed = p.spans(p.document_order(tokens, 2, seed, separate_final=True, digits=1), width=4).cache()
    order = [r.doc_id for r in placed.orderBy("pos").collect()]
    live = {i for i, n in sizes.items() if n}
    assert sorted(order) == sorted(list(live) * 2) and set(order[: len(live)]) == live
    stream = [t for doc in order for t in rows[doc][1]]
    for seq_len in (4, 7):
        got = [(r.doc_pos, r.offset) for r in p.sample_index(placed, seq_len).orderBy("sample_id").collect()]
        assert got == _loop_index([sizes[doc] for doc in order], seq_len)
        samples = p.materialize_samples(placed, tokens, seq_len).orderBy("sample_id").collect()
        assert [r.tokens for r in samples] == [
            stream[j * seq_len : j * seq_len + seq_len + 1] for j in range((len(stream) - 1) // seq_len)]
        assert all(r.inputs == r.tokens[:-1] and r.labels == r.tokens[1:] for r in samples)


def test_masks_at_document_ends(spark):
    df = spark.createDataFrame([([5, 6, 7, 0, 8, 9, 4],), ([0, 0, 3],), ([1, 2, 0],)], "x array<int>")
    rows = df.select(p.loss_mask("x").alias("m"), p.position_ids("x").alias("q"), p.cu_seqlens("x").alias("c"),
                     p.segment_ids("x").alias("s"), p.position_ids("x", False).alias("plain"),
                     p.max_seqlen(p.cu_seqlens("x")).alias("mx"), p.loss_mask("x", False).alias("all")).collect()
    assert (rows[0].m, rows[0].q, rows[0].c, rows[0].mx) == ([1, 1, 1, 0, 1, 1, 1], [0, 1, 2, 3, 0, 1, 2], [0, 4, 7], 4)
    assert rows[0].s == [0, 0, 0, 0, 1, 1, 1] and rows[0].plain == list(range(7)) and rows[0]["all"] == [1] * 7
    assert (rows[1].q, rows[1].c) == ([0, 0, 0], [0, 1, 2, 3]) and (rows[2].q, rows[2].c) == ([0, 1, 2], [0, 3])


def test_split_and_epochs(spark):
    got = p.split_docs(spark.range(100).withColumnRenamed("id", "doc_id"), "80,15,5", parts=5).groupBy("split").count()
    assert {r.split: r["count"] for r in got.collect()} == {"train": 80, "valid": 15, "test": 5}
    assert p.epochs_needed(1000, 9, 100) == (1, False)
    assert p.epochs_needed(1000, 12, 100) == (2, True) and p.epochs_needed(1000, 18, 100) == (2, False)


def test_cached_builds_once(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    config = {"seq_len": 8, "seed": random.random()}
    assert p.cached(spark, config, build).count() == p.cached(spark, config, build).count() == 3 and len(calls) == 1


def _weights(spark, ws):
    return spark.createDataFrame(list(enumerate(ws)), "dataset_id long, weight double")


def _greedy(ws, n):
    counts, out = [0] * len(ws), []
    for i in range(n):
        errors = [w * max(i, 1) - c for w, c in zip(ws, counts)]
        d = errors.index(max(errors))
        out.append((i, d, counts[d]))
        counts[d] += 1
    return out


def test_a_file_in_parts_is_numbered_through(spark, tmp_path):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    for folder, name, ids in (("b c+d", "part-1", [3, 4]), ("b c+d", "part-0", [1, 2]), ("a", "part-0", [9]), ("a", "part-1", [])):
        (tmp_path / folder).mkdir(exist_ok=True)
        lines = [f'{{"doc_id": {i}, "text": "t"}}\n' for i in ids]
        (tmp_path / folder / name).write_text("".join(["\n", *lines]))
    rows = io.read_jsonl(spark, [str(tmp_path / "b c+d"), str(tmp_path / "a")], schema, in_parts=True)
    got = rows.select("file_index", "line_no", "doc_id", "_corrupt_record").collect()
    assert sorted(got) == [(1, 1, 9, None), *[(2, n, i, None) for n, i in ((1, 1), (2, 2), (4, 3), (5, 4))]]


def test_json_lines_of_a_language_are_written_by_several_tasks(spark, tmp_path):
    rows = [(i, f"text {i} " + "word " * 40, "en") for i in range(2000)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # so small a table would be one partition again
    try:
        known = set(Path(urlparse(durable_dir(spark)).path).glob("jsonl-*"))
        got = entry.queries()["s1_read_jsonl"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset(key)
    (path,) = set(Path(urlparse(durable_dir(spark)).path).glob("jsonl-*")) - known
    assert len(list(path.glob("part=part-en/part-*"))) > 1
    whole = [(r.doc_id, r.line_no) for r in got if not r.corrupt]
    assert sorted(whole) == [(i, i) for i in range(2000) if i % 50 != 9] and {r.file_index for r in got} == {1}


@pytest.mark.parametrize("call", ["encode", "decode", "bpe", "back", "profiles", "detect"])
def test_batches_between_spark_and_python_are_bounded(spark, docs, vocab, call):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    merges = spark.createDataFrame([(0, 117, 105, 257, 2)], "rank int, left int, right int, id int, n long")
    profiles = spark.createDataFrame([("en", "a", 1.0)], "lang string, gram string, p double")
    {
        "encode": lambda: k.encoder(vocab),
        "decode": lambda: k.decoder(vocab),
        "bpe": lambda: bpe.tokenize(docs, merges),
        "back": lambda: bpe.detokenize(docs.selectExpr("doc_id", "array(1) as tokens"), merges),
        "profiles": lambda: language.train_lang_profiles(docs.selectExpr("'en' as lang", "text")),
        "detect": lambda: language.detect_lang(docs, profiles),
    }[call]()
    assert int(spark.conf.get(key)) == BATCH_BYTES
    spark.conf.set(key, "123456")
    k.encoder(vocab)
    assert spark.conf.get(key) == "123456"  # a size of the session's own stays
    spark.conf.unset(key)


@pytest.mark.parametrize("ws", [[0.8, 0.2], [0.5, 0.5], [0.1, 0.2, 0.3, 0.4], [0.34, 0.33, 0.33], [1.0, 0.0]])
def test_blend_exact_in_blocks_equals_the_loop(spark, ws):
    for warm in (0, 30):
        got = b.blend_exact(spark, _weights(spark, ws), 230, block=37, warm_up=warm).orderBy("position").collect()
        assert [tuple(r) for r in got] == _greedy(ws, 230)


@pytest.mark.parametrize("chain", [1, 74, 150])
def test_blend_exact_in_chains_equals_the_loop(spark, chain):
    ws = [0.1, 0.2, 0.3, 0.4]
    for warm in (0, 30):
        got = b.blend_exact(spark, _weights(spark, ws), 230, block=37, warm_up=warm, chain=chain).orderBy("position").collect()
        assert [tuple(r) for r in got] == _greedy(ws, 230)


def test_small_blocks_of_a_blend_share_tasks(spark):
    def written():
        return set(Path(urlparse(durable_dir(spark)).path).glob("blend-*/part-*"))

    known = written()
    got = b.blend_exact(spark, _weights(spark, [0.7, 0.3]), 3000, block=10, warm_up=5)
    assert got.count() == 3000 and len(written() - known) <= 4


def test_blend_scalable_keeps_proportions(spark):
    rng = np.random.default_rng(3)
    ws = rng.dirichlet([1.0] * 6).tolist()
    n = 2000
    got = b.blend_scalable(_weights(spark, ws), n, width=150).orderBy("position").collect()
    assert [r.position for r in got] == list(range(n))
    counts = np.zeros(6)
    for i, r in enumerate(got):
        assert r.dataset_sample_id == counts[r.dataset_id]
        counts[r.dataset_id] += 1
        assert np.abs(counts - np.array(ws) * (i + 1)).max() < 2.5
    exact = np.bincount([d for _, d, _ in _greedy(ws, n)], minlength=6)
    assert np.abs(counts - exact).max() <= 1


def test_ranks_partition_positions_and_resume(spark):
    plan = spark.range(1003).withColumnRenamed("id", "position")
    full = b.assign_ranks(plan, 1003, 0, 4, 8).collect()
    assert len(full) == 1003 // 32 * 32 and len({(r.batch, r.rank, r.slot) for r in full}) == len(full)
    assert all(r.position == r.batch * 32 + r["rank"] * 4 + r.slot for r in full)
    done = b.consumed_samples(5, 0, 64)
    rest = b.resume(plan, 1003, done, 4, 8).select("position", "rank", "slot")
    suffix = b.assign_ranks(plan, 1003, 0, 4, 8).where(F.col("position") >= done).select("position", "rank", "slot")
    assert rest.exceptAll(suffix).isEmpty() and suffix.exceptAll(rest).isEmpty()


def test_random_ranks(spark):
    plan = spark.range(100).withColumnRenamed("id", "position")
    a = b.assign_ranks_random(plan, 100, 1, 4, 3).collect()
    assert len(a) == 96 and all(r["rank"] == r.position // 32 for r in a)
    for rank in range(3):
        assert sorted(r.draw for r in a if r["rank"] == rank) == list(range(32))
    again = b.assign_ranks_random(plan, 100, 2, 4, 3).collect()
    assert {(r.position, r.draw) for r in a} != {(r.position, r.draw) for r in again}


def test_two_stages_restart_and_wrap(spark):
    sizes = spark.createDataFrame([(0, 50), (1, 1000)], "dataset_id long, size long")
    got = b.stage_plan([("one", 312, _weights(spark, [0.1, 0.9])), ("two", 312, _weights(spark, [0.9, 0.1]))], 64, sizes)
    rows = got.collect()
    assert sorted(r.position for r in rows) == list(range(624))
    two = [r for r in rows if r.stage == "two"]
    assert min(r.stage_position for r in two) == 0 and min(r.position for r in two) == 312
    assert max(r.dataset_sample_id for r in rows if r.dataset_id == 0) == 49
    assert max(r.dataset_epoch for r in two if r.dataset_id == 0) == 5


def test_dataset_sizes_surplus(spark):
    got = b.dataset_sizes(_weights(spark, [0.8, 0.2]), 1000).orderBy("dataset_id").collect()
    assert [r.need for r in got] == [804, 201]


def test_upsampling_keeps_source_totals(spark):
    rng = random.Random(2)
    rows = [(i, f"s{i % 2}", 2000 if rng.random() < 0.05 else 100) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")
    up = c.repeat_copies(c.upsample_long(df, 1000, 0.6))
    for s in ("s0", "s1"):
        before = sum(n for _, x, n in rows if x == s)
        now = up.where(F.col("source") == s).agg(
            F.sum("n_tokens").alias("t"), F.sum(F.when(F.col("n_tokens") >= 1000, F.col("n_tokens"))).alias("l")).first()
        assert now.t == pytest.approx(before, rel=0.1) and now.l / now.t == pytest.approx(0.6, abs=0.06)
