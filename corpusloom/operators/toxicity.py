"""Toxicity: term density, spam, URL block lists, audit samples, a linear classifier, reports."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions.ordering import md5_key
from corpusloom.functions.text import col, let, ratio, top_count, words

# Mild insults found in the test corpus; severe terms are dropped at any density.
TERMS = {
    "en": {"mild": ["idiot", "clown", "moron", "scum", "pathetic"], "severe": ["worthless"]},
    "fr": {"mild": ["idiot", "crétin"], "severe": ["salaud"]},
    "de": {"mild": ["idiot", "trottel"], "severe": ["abschaum"]},
    "es": {"mild": ["idiota", "payaso"], "severe": ["escoria"]},
}


def bare_words(text: Column | str) -> Column:
    """Lower-cased words without leading and trailing non-letters."""
    return F.transform(words(F.lower(col(text))), lambda w: F.regexp_replace(w, r"^[^\p{L}]+|[^\p{L}]+$", ""))


def _in_list(listed: list[str]):
    return lambda w: w.isin(*listed)


def _hits(lang: Column, bare: Column, terms: dict, kind: str) -> Column:
    n = F.lit(0)
    for code, lists in terms.items():
        n = F.when(lang == code, F.size(F.filter(bare, _in_list(lists[kind])))).otherwise(n)
    return n


def _listed_hits(df: DataFrame, terms: DataFrame, lang: str) -> tuple[DataFrame, Column, Column]:
    """The same from a table (lang, term, severity), which travels as one row of lists per language."""
    lists = terms.groupBy(F.col("lang").alias("_tl")).agg(
        *[F.collect_set(F.when(F.col("severity") == k, F.lower("term"))).alias(f"_{k}") for k in ("mild", "severe")]
    )
    joined = df.join(F.broadcast(lists), F.col(lang) == F.col("_tl"), "left")
    hits = lambda k: F.size(F.filter("_bare", lambda w: F.array_contains(f"_{k}", w)))
    return joined, F.when(F.col("_tl").isNotNull(), hits("mild")), F.when(F.col("_tl").isNotNull(), hits("severe"))


def toxic_density(
    df: DataFrame, terms: dict | DataFrame = TERMS, limit: float = 0.01, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Share of listed terms among all words, by the row's language; severe terms have zero tolerance.

    ``terms`` is a dictionary like TERMS or a table (lang, term, severity).  Rows in a language without a list
    are not judged: their counts, density and ``dropped`` are null.
    """
    d = df.withColumn("_bare", bare_words(text))
    if isinstance(terms, DataFrame):
        d, mild, severe = _listed_hits(d, terms, lang)
    else:
        listed = col(lang).isin(*terms)
        mild, severe = (F.when(listed, _hits(col(lang), F.col("_bare"), terms, k)) for k in ("mild", "severe"))
    return (
        d.withColumns({"n_words": F.size("_bare"), "n_terms": mild + severe, "n_severe": severe})
        .withColumn("density", F.when(F.col("n_terms").isNotNull(), ratio(F.col("n_terms"), F.col("n_words"))))
        .withColumn("dropped", (F.col("density") > limit) | (F.col("n_severe") > 0))
        .drop("_bare", "_tl", "_mild", "_severe")
    )


def spam_score(df: DataFrame, min_len: int = 4, limit: float = 0.2, text: str = "text") -> DataFrame:
    """Keyword stuffing: share of the most frequent word of at least ``min_len`` letters."""
    bare = F.filter(bare_words(text), lambda w: F.length(w) >= min_len)
    d = df.withColumn("_b", bare)
    return (
        d.withColumn("n_terms", F.size("_b"))
        .withColumn("spam_score", ratio(top_count(F.col("_b")), F.col("n_terms")))
        .withColumn("is_spam", F.col("spam_score") > limit)
        .drop("_b")
    )


def host_suffixes(host: Column) -> Column:
    """a.b.example.com -> itself and every parent domain."""
    return let(
        F.split(host, r"\."),
        lambda ls: F.transform(
            F.sequence(F.lit(1), F.size(ls)), lambda i: F.array_join(F.slice(ls, i, F.size(ls)), ".")
        ),
    )


def url_block(pages: DataFrame, domains: DataFrame) -> DataFrame:
    """Pages whose host is neither a blocked domain nor below one.

    Suffixes are made once per host, so a huge site is one row; how the blocked hosts meet the pages is
    left to Spark, which knows their size by then.
    """
    hosted = pages.withColumn("host", F.lower(F.parse_url(F.col("url"), F.lit("HOST"))))
    hosts = hosted.where(F.col("host").isNotNull()).groupBy("host").agg(F.lit(1).alias("_one")).select(
        "host", F.explode(host_suffixes(F.col("host"))).alias("domain")
    )
    bad = hosts.join(domains.select("domain").distinct(), "domain", "left_semi").select("host").distinct()
    return hosted.join(bad, "host", "left_anti")


def train_linear(df: DataFrame, label: str, text: str = "text", features: int = 1 << 16, seed: int = 7) -> PipelineModel:
    """Bag-of-words logistic regression on labelled documents (shared by toxicity and quality)."""
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_tok", pattern=r"\s+"),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_idf", minDocFreq=2),
        LogisticRegression(featuresCol="_idf", labelCol=label, regParam=0.01, maxIter=30, standardization=False),
    ]
    return Pipeline(stages=stages).fit(df)


def score_linear(model: PipelineModel, df: DataFrame, out: str) -> DataFrame:
    """Add the probability of the positive class."""
    scored = model.transform(df).withColumn(out, vector_to_array("probability")[1])
    return scored.select(*df.columns, out)


def audit_sample(df: DataFrame, n: int, by: list[str], seed: int = 0, doc: str = "doc_id") -> DataFrame:
    """``n`` documents per stratum in hash order, for a human or a model to judge.

    Spark applies the rank limit on the map side too, so a stratum of any size sends at most ``n``
    rows per map task.
    """
    order = W.partitionBy(*by).orderBy("_h", doc)
    return (
        df.withColumn("_h", md5_key(seed, doc))
        .withColumn("sample_no", F.row_number().over(order))
        .where(F.col("sample_no") <= n)
        .drop("_h")
    )


def classifier_report(df: DataFrame, predicted: Column, actual: Column, by: str = "lang") -> DataFrame:
    """Confusion counts, precision and recall per language, with a total row (null language)."""
    p, a = predicted.cast("int"), actual.cast("int")
    count = lambda cond: F.sum(F.when(cond, 1).otherwise(0))
    out = (
        df.select(by, p.alias("_p"), a.alias("_a"))
        .rollup(by)
        .agg(
            count((F.col("_p") == 1) & (F.col("_a") == 1)).alias("tp"),
            count((F.col("_p") == 1) & (F.col("_a") == 0)).alias("fp"),
            count((F.col("_p") == 0) & (F.col("_a") == 1)).alias("fn"),
            count((F.col("_p") == 0) & (F.col("_a") == 0)).alias("tn"),
        )
    )
    return out.withColumns(
        {
            "precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")),
            "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn")),
        }
    )
