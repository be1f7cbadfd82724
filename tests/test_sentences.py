"""Learned sentence boundaries: what a reader expects, and the edges."""

from __future__ import annotations

import math
import random

import pytest

from pyspark.sql import functions as F

from corpusloom.operators import sentences as S

DOCS = "doc_id long, lang string, text string"
NAMES = {"en": ["Smith", "Jones", "Baker", "Miller"], "de": ["Meier", "Schulz", "Huber", "Wolf"]}
WORDS = {"en": "the house was old and many people came here again while others left early".split(),
         "de": "das haus war alt und viele leute kamen wieder hierher als andere gingen".split()}
TITLE = {"en": "Dr.", "de": "Hr."}


def corpus(lang: str, n: int = 150):
    rng = random.Random(lang)
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(2, 6)):
            w = rng.choices(WORDS[lang], k=rng.randint(4, 9))
            if rng.random() < 0.5:
                w[2:2] = [TITLE[lang], rng.choice(NAMES[lang])]
            if rng.random() < 0.3:
                w[1:1] = ["on", "3.", "October"] if lang == "en" else ["am", "3.", "Oktober"]
            if rng.random() < 0.3:
                w[1:1] = ["J.", rng.choice(NAMES[lang])]
            if rng.random() < 0.3:
                w[1:1] = ["about", "2.5", "and", "3.14"]
            parts.append(" ".join(w).capitalize().replace("dr.", "Dr.").replace("hr.", "Hr.") + ".")
        out.append(" ".join(parts))
    # capitalize() lowered names and months; put them back.
    for names in (*NAMES.values(), ["October", "Oktober", "J."]):
        out = [t if not any(x.lower() in t for x in names) else _restore(t, names) for t in out]
    return out


def _restore(text, names):
    for x in names:
        text = text.replace(f" {x.lower()}", f" {x}")
    return text


@pytest.fixture(scope="module")
def model(spark):
    rows = [(k, lang, t) for lang in ("en", "de") for k, t in enumerate(corpus(lang))] + [(900, "en", None), (901, None, "No. One."), (902, "en", "")]
    found, decisions = S.train(spark.createDataFrame(rows, DOCS).repartition(3))
    return found.cache(), decisions.cache()


def split(spark, model, lang, text):
    return S.split(spark.createDataFrame([(1, lang, text)], DOCS), model[1]).first()["sentences"]


@pytest.mark.parametrize("lang, text, n", [
    ("en", "People came again while Dr. Smith left early. The house was old.", 2),
    ("de", "Viele leute kamen als Hr. Meier wieder hierher gingen. Das haus war alt.", 2),
    ("en", "Many on 3. October came here. Others left early.", 2),
    ("de", "Viele am 3. Oktober kamen wieder. Andere gingen.", 2),
    ("en", "The J. Jones house was old. Many J. Baker people came.", 2),
    ("en", "It was about 2.5 and 3.14 again. Others left.", 2),
    ("en", "Was it old? It was! Many came... Others left... and came again.", 4),
])
def test_boundaries_by_language(spark, model, lang, text, n):
    got = split(spark, model, lang, text)
    assert "".join(got) == text and len(got) == n, got


def test_model_finds_the_titles(model):
    rows = model[0].collect()
    abbr = {(r["lang"], r["a"]) for r in rows if r["kind"] == S.ABBREV}
    assert ("en", "dr") in abbr and ("de", "hr") in abbr and ("de", "dr") not in abbr
    assert not abbr & {(x, w) for x in WORDS for w in WORDS[x]}
    assert {("en", "##", "october"), ("de", "##", "oktober")} <= {(r["lang"], r["a"], r["b"]) for r in rows if r["kind"] == S.PAIR}


def test_log_likelihood_equals_the_plain_formula(spark):
    def plain(a, b, ab, n):
        def ll(k, m, p):
            return (k * math.log(p) if k else 0) + ((m - k) * math.log(1 - p) if m - k else 0)

        p, p1, p2 = b / n, ab / a, (b - ab) / (n - a)
        return 2 * (ll(ab, a, p1) + ll(b - ab, n - a, p2) - ll(ab, a, p) - ll(b - ab, n - a, p))

    cases = [(10, 20, 5, 1000), (10, 20, 10, 1000), (7, 7, 7, 50), (3, 40, 1, 500), (5, 9, 0, 100)]
    df = spark.createDataFrame([tuple(map(float, c)) for c in cases], "a double, b double, ab double, n double")
    got = [r[0] for r in df.select(S.log_likelihood(*(S.F.col(c) for c in ("a", "b", "ab", "n")))).collect()]
    assert got == pytest.approx([plain(*c) for c in cases])


def test_texts_come_back_whole(spark, model):
    texts = ["", "   ", None, "one", " lead. Trail \n", "No stop", "a.\n\nb. C.", "Dr. Smith. " * 3000, "é. È! 漢字。 x"]
    rows = S.split(spark.createDataFrame([(k, "en", t) for k, t in enumerate(texts)], DOCS), model[1]).collect()
    got = {r["doc_id"]: r["sentences"] for r in rows}
    assert got[0] == [] and got[1] == [] and got[2] is None and len(got) == len(texts)
    assert all("".join(got[k]) == t for k, t in enumerate(texts) if t and t.strip())


def test_unknown_languages_and_empty_tables(spark, model):
    assert split(spark, model, "xx", "Dr. Smith came. Left.") == ["Dr. ", "Smith came. ", "Left."]
    assert split(spark, model, None, "Dr. Smith.") == ["Dr. ", "Smith."]
    empty = spark.createDataFrame([], DOCS)
    found, decisions = S.train(empty)
    assert found.count() == 0 and decisions.count() == 0 and S.split(empty, decisions).count() == 0


def test_words_are_cut_without_regular_expressions(spark):
    """Each of them ran over every word, several times in ``split``."""
    edges = r"^[ \t\n\r\f\"'(\[{«“„‘]+|[ \t\n\r\f\"')\]}»”’,;:]+\z"
    rng = random.Random(5)
    texts = ["", " ", "(", "):", "'a'", "«É»,\n"] + ["".join(rng.choices(" \t\n\"'()[]{}«»“”„‘’,;:.!aé", k=rng.randint(1, 9))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(S.core(F.col("t")).alias("a"), F.regexp_replace("t", edges, "").alias("b")).collect()
    assert all(r.a == r.b for r in got)
    assert "regexp" not in df.select(S.core(F.col("t")))._jdf.queryExecution().toString()
