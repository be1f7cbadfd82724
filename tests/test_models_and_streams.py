"""Linear models, k-means clusters, and row-local operators on a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import clean, dedup, filters, pii, quality, toxicity

SF = "/root/testdata/sf0.001"


def test_linear_model_separates_and_repeats(spark):
    rows = [(i, f"good calm text number {i}" if i % 2 else f"awful nasty stuff number {i}", i % 2) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    train, test = df.where("doc_id < 60"), df.where("doc_id >= 60")
    a = quality.score_linear(quality.train_linear(train, "label"), test, "p").orderBy("doc_id").collect()
    b = quality.score_linear(quality.train_linear(train, "label"), test, "p").orderBy("doc_id").collect()
    assert all((r.p > 0.5) == bool(r.label) for r in a)
    assert [round(r.p, 9) for r in a] == [round(r.p, 9) for r in b]


def test_toxicity_model_beats_the_base_rate(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    rows = docs.join(labels, "doc_id").withColumn("train", F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1) < "c").cache()
    scored = toxicity.score_linear(toxicity.train_linear(rows.where("train"), "toxic"), rows.where("not train"), "p")
    means = {r.toxic: r.m for r in scored.groupBy("toxic").agg(F.avg("p").alias("m")).collect()}
    assert means[1] > means[0]


def test_kmeans_clusters_feed_semantic_dedup(spark):
    rows = [(i, [float(i % 2) + 0.001 * (i // 2), 1.0 - float(i % 2)]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    kept = dedup.semantic_dedup(dedup.assign_clusters(df, 2), 0.01, "cluster")
    assert sorted(r.vec_id for r in kept.collect()) == [0, 1]


def test_row_local_operators_on_a_stream(spark):
    def curate(df):
        text = clean.drop_symbol_lines(clean.dehyphenate("text"), 0.5)
        rows = filters.gopher(df.withColumn("text", text)).where("passes")
        return pii.redact_pii(rows.select("doc_id", "lang", "text"))

    path = f"{SF}/documents.parquet"
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "documents.parquet").parquet(SF)
    q = curate(stream).writeStream.format("memory").queryName("curated").start()
    q.processAllAvailable()
    q.stop()
    want = curate(spark.read.parquet(path))
    got = spark.table("curated")
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()
