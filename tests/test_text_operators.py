"""Cleaning, language, filters, toxicity and personal data on literal rows."""

from __future__ import annotations

import unicodedata

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as t
from corpusloom.operators import clean, filters, language, pii, quality, toxicity


def _docs(spark, *texts, lang="en"):
    return spark.createDataFrame([(i, lang, f"s{i % 2}", x) for i, x in enumerate(texts)],
                                 "doc_id long, lang string, source string, text string")


TRICKY = ["a b  c　d\x1ce", "", "   ", " x ", "one...", "tab\tand\nnew\x0bline", "déjà vu \U0001F600 z"]


def test_words_follow_python_split(spark):
    rows = _docs(spark, *TRICKY).select(
        t.words("text").alias("w"), t.word_count("text").alias("n"), t.visible_chars("text").alias("v")
    ).collect()
    assert [r.w for r in rows] == [x.split() for x in TRICKY]
    assert [r.n for r in rows] == [len(x.split()) for x in TRICKY]
    assert [r.v for r in rows] == [sum(map(len, x.split())) for x in TRICKY]


def test_gopher_boundaries(spark):
    def passes(x):
        ws = x.split()
        if not 50 <= len(ws) <= 100_000:
            return False
        if not 3 <= sum(map(len, ws)) / len(ws) <= 10:
            return False
        return sum(w.endswith("...") for w in ws) / len(ws) <= 0.3

    texts = ["word " * 49, "word " * 50, "ab " * 60, "abc " * 60, "elevenchars " * 60, "tenletters " * 60,
             "so... " * 16 + "word " * 34, "so... " * 15 + "word " * 35, ""]
    got = filters.gopher(_docs(spark, *texts)).orderBy("doc_id").collect()
    assert [r.passes for r in got] == [passes(x) for x in texts]
    assert got[6].ellipsis_words == pytest.approx(0.32)


def test_line_rules(spark):
    x = "- item one\n* item two\nplain\nends...\nA whole sentence that is long enough to count."
    cols = {**filters.bullet_flags("text"), **filters.ellipsis_line_flags("text"), **filters.short_line_flags("text")}
    r = _docs(spark, x).select(*[c.alias(k) for k, c in cols.items()]).first()
    assert (r.bullet_ratio, r.ellipsis_ratio, r.short_line_ratio) == (0.4, 0.2, 0.8)


def test_c4_lines(spark):
    x = "Kept line.\nno end\nEnable JavaScript now.\nCall 555-123-4567.\nWhy?"
    r = filters.c4_lines(_docs(spark, x)).first()
    assert r.text == "Kept line.\nWhy?" and (r.n_no_punct, r.n_javascript, r.n_phone, r.n_kept) == (1, 1, 1, 2)


def test_repetition_counts(spark):
    r = _docs(spark, "a b c a b c a b c", "a b").select(
        *[c.alias(k) for k, c in filters.repetition_flags("text", 3).items()]
    ).collect()
    assert r[0].dup_ngram_share == pytest.approx(1 - 3 / 7) and r[0].top_ngram_share == pytest.approx(3 / 7)
    assert (r[1].dup_ngram_share, r[1].top_ngram_share) == (0.0, 0.0)


def test_filter_report_failed_only(spark):
    rows = [("en", 10, True, False), ("en", 20, False, False), ("fr", 30, True, True)]
    df = spark.createDataFrame(rows, "lang string, n_chars long, a boolean, b boolean")
    got = {(r.lang, r.rule): r for r in filters.filter_report(df, {"a": F.col("a"), "b": F.col("b")}, ["lang"]).collect()}
    assert (got[None, "b"].n_failed, got[None, "b"].n_failed_only, got[None, "b"].chars_lost) == (2, 1, 30)
    assert got["fr", "a"].n_kept == 1 and got["en", "a"].n_failed_only == 0


def test_unicode_cleaning(spark):
    x = "ﬁne oﬃce café plain"
    df = _docs(spark, x, "ascii only", "cafÃ© au lait", "café")
    got = df.select(clean.normalize_unicode("text").alias("n"), clean.repair_encoding("text").alias("r")).collect()
    assert got[0].n == unicodedata.normalize("NFC", "fine office café plain") and got[1].n == "ascii only"
    assert got[2].r == "café au lait" and got[3].r == "café"


def test_invalid_utf8_is_replaced(spark):
    df = spark.createDataFrame([(bytearray(b"ab\xff\xfecd"),)], "raw binary")
    assert df.select(clean.valid_text("raw").alias("x")).first().x == "ab��cd"


def test_dehyphenate_and_symbols(spark):
    df = _docs(spark, "the en-\nvironment", "text line\n123 456 | 7.8 9\n\nend")
    got = df.select(clean.dehyphenate("text").alias("d"), clean.drop_symbol_lines("text").alias("s")).collect()
    assert got[0].d == "the environment" and got[1].s == "text line\n\nend"


def test_references_are_decoded_once(spark):
    page = "&eacute;&uuml;&Eacute; &#38;lt; &amp;amp; &amp;#65; &hearts;&euro;&apos; &#0; &#xD800; &nosuch; &lt &; a&b &alpha;&#x1F600;"
    df = spark.createDataFrame([(page,), (None,), ("",), ("plain",)], "html string")
    got = [r.text for r in clean.html_to_text(df).collect()]
    assert got == ["éüÉ &lt; &amp; &#65; ♥€' &#0; &#xD800; &nosuch; &lt &; a&b α\U0001f600", None, "", "plain"]


def test_html_entities_and_quotes(spark):
    html = ('<html><head><title>T</title></head><body><!-- c --><nav>menu</nav><p title="a > b">x &amp;lt; y&#233;&#x41;</p>'
            "<script>if (a < b) {}</script><ul><li>one<li>two</ul>&#999999999; &unknown;</body></html>")
    df = spark.createDataFrame([(html,)], "html string")
    assert clean.html_to_text(df).first().text == "x &lt; yéA\none\ntwo\n&#999999999; &unknown;"


def test_strip_repeated_lines_hot_header(spark):
    rows = [(i, "s", f"Header\nbody {i}\nFooter {i % 2}") for i in range(20)] + [(99, "t", "Header\nother")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: (r.text, r.n_removed) for r in clean.strip_repeated_lines(df, k=5, target=3).collect()}
    assert got[3] == ("body 3", 2) and got[99] == ("Header\nother", 0) and len(got) == 21


EN = "the committee has published its report on the new housing plan and the members agreed to meet again"
ID = "pemerintah telah mengumumkan rencana baru untuk pembangunan perumahan dan masyarakat menyambut dengan baik"


def _profiles(spark):
    df = spark.createDataFrame([("en", EN), ("id", ID)], "lang string, text string")
    return language.train_lang_profiles(df, 200)


def test_long_ngrams_are_refused(spark):
    with pytest.raises(ValueError):
        language.detect_lang(_docs(spark, "x"), _profiles(spark), sizes=(1, 4))


def test_language_detection_both_ways(spark):
    df = _docs(spark, "the members agreed on the plan", "masyarakat menyambut rencana baru", "", "😀😀", "THE\nREPORT")
    prof = _profiles(spark).cache()
    small = language.detect_lang(df, prof).orderBy("doc_id").collect()
    large = language.detect_lang(df, prof, joined=True).orderBy("doc_id").collect()
    assert [r.lang_pred for r in small] == ["en", "id", "unknown", "unknown", "en"]
    for a, b in zip(small, large):
        assert a.lang_pred == b.lang_pred and a.confidence == pytest.approx(b.confidence)


def test_mixed_paragraphs(spark):
    df = spark.createDataFrame(
        [(1, "id", "\n".join([ID, ID, EN])), (2, "id", "\n".join([EN, EN, EN, ID])), (3, "id", "\n\n")],
        "doc_id long, lang string, text string")
    got = {r.doc_id: r for r in language.paragraph_lang(df, _profiles(spark), F.col("lang"), window=0).collect()}
    assert got[1].target_share == pytest.approx(2 / 3) and got[1].keep
    assert got[2].target_share == pytest.approx(0.25) and not got[2].keep


def test_toxic_density_and_severe(spark):
    df = _docs(spark, "you idiot " + "word " * 98, "IDIOT, moron! " + "word " * 48, "worthless " + "w " * 500, "fine")
    got = toxicity.toxic_density(df).orderBy("doc_id").collect()
    assert [r.dropped for r in got] == [False, True, True, False] and got[1].n_terms == 2


def test_spam_and_url_block(spark):
    r = toxicity.spam_score(_docs(spark, "cheap pills cheap pills cheap deal")).first()
    assert r.spam_score == pytest.approx(0.5) and r.is_spam
    pages = spark.createDataFrame(
        [(1, "http://a.bad.com/x"), (2, "https://BAD.com"), (3, "http://notbad.com/"), (4, "http://ok.org/bad.com")],
        "page_id long, url string")
    domains = spark.createDataFrame([("bad.com",)], "domain string")
    assert sorted(x.page_id for x in toxicity.url_block(pages, domains).collect()) == [3, 4]


def test_classifier_report(spark):
    df = spark.createDataFrame([("en", 1, 1), ("en", 1, 0), ("fr", 0, 1), ("fr", 0, 0)], "lang string, p int, a int")
    got = {r.lang: r for r in toxicity.classifier_report(df, F.col("p"), F.col("a")).collect()}
    assert (got[None].tp, got[None].fp, got[None].fn, got[None].tn) == (1, 1, 1, 1)
    assert got["en"].precision == 0.5 and got["fr"].recall == 0.0


def test_pii_kinds_positions_and_redaction(spark):
    x = ("Mail jo.doe+x@mail.example.org or +65 1234 5678, card 4111 1111 1111 1111, host 192.168.1.1, "
         "SSN 123-45-6789, NRIC S1234567D, born on 01/02/1990. Call (743) 555-3824")
    df = _docs(spark, x, "nothing here")
    found = sorted((r.start, r.kind, r.value) for r in pii.find_pii(df).collect())
    assert [k for _, k, _ in found] == ["EMAIL", "PHONE", "CARD", "IP", "ID", "ID", "DOB", "PHONE"]
    assert all(x[s : s + len(v)] == v for s, _, v in found)
    red = pii.redact_pii(df).orderBy("doc_id").collect()
    assert red[0].text == ("Mail [EMAIL] or [PHONE], card [CARD], host [IP], SSN [ID], NRIC [ID], [DOB]. Call [PHONE]")
    assert (red[0].n_redacted, red[1].text, red[1].n_redacted) == (8, "nothing here", 0)


def test_pii_locale_and_density(spark):
    assert pii.find_pii(_docs(spark, "DNI 12345678Z", lang="es")).first().kind == "ID"
    assert pii.find_pii(_docs(spark, "DNI 12345678Z", lang="en")).count() == 0
    dump = "a@b.co c@d.co e@f.co"
    kept = pii.drop_pii_dense(_docs(spark, dump, "a@b.co " + "word " * 99), max_share=0.3)
    assert [r.doc_id for r in kept.collect()] == [1]


def test_perplexity_backs_off(spark):
    docs = _docs(spark, "the cat sat on the mat", "the dog sat", "unknown words only here", "one", "")
    lm = quality.train_ngram_lm(docs.where("doc_id < 2")).cache()
    a = {r.doc_id: r.perplexity for r in quality.perplexity(docs, lm).collect()}
    n = {r.doc_id: r.n_bigrams for r in quality.perplexity(docs, lm).collect()}
    assert a.keys() == {0, 1, 2, 3, 4} and a[3] is None and a[4] is None and n == {0: 5, 1: 2, 2: 3, 3: 0, 4: 0}
    # "the" is followed by cat, mat and dog, one time each; the other words of document 1 have one successor.
    assert a[1] == pytest.approx(3 ** 0.5) and a[2] > a[0] == pytest.approx(9 ** 0.2)


def test_quality_buckets_shares(spark):
    df = spark.createDataFrame([(i, "s", float(i)) for i in range(101)], "doc_id long, source string, score double")
    got = quality.quality_buckets(df, "score").groupBy("dataset").count().collect()
    assert {r.dataset: r["count"] for r in got} == {"s-head-25": 26, "s-middle-50": 50, "s-tail-25": 25}


def test_resource_tiers(spark):
    df = spark.createDataFrame([("a", 11), ("b", 10), ("c", 3), ("d", 2)], "lang string, n_tokens long")
    got = {r.lang: r.tier for r in quality.resource_tiers(df, 3, 10).collect()}
    assert got == {"a": "high", "b": "mid", "c": "mid", "d": "low"}


def test_repair_of_broken_encodings(spark):
    good = ["É", "“quoted”", "a – b — c", "Привет, мир", "Ελλάδα", "naïve café €5 ™", "日本語", "plain", "", "ÿþ", "Ã alone", "dž ž", "x\u0081y é"]
    latin = [t.encode().decode("latin-1") for t in good]
    symbols = dict(zip(clean.WINDOWS_BYTES, clean.WINDOWS_SYMBOLS))
    windows = ["".join(symbols.get(c, c) for c in t) for t in latin]
    df = _docs(spark, *good, *latin, *windows)
    got = [r.t for r in df.select("doc_id", clean.repair_encoding("text").alias("t")).orderBy("doc_id").collect()]
    assert got[: len(good)] == good and got[len(good) : 2 * len(good)] == good and got[2 * len(good) :] == good


def test_composition(spark):
    df = _docs(spark, "e\u0301", "ﬁn", "plain", "Å", "가")
    got = [r.t for r in df.select("doc_id", clean.normalize_unicode("text").alias("t")).orderBy("doc_id").collect()]
    assert got == ["é", "fin", "plain", "Å", "가"]


@pytest.mark.parametrize("lang,phone", [
    ("fr", "06 12 34 56 78"), ("fr", "+33 6 12 34 56 78"), ("de", "030 12345678"), ("de", "+49 30 12345678"),
    ("es", "612 345 678"), ("es", "+34 612 345 678"), ("en", "(743) 555-3824"), ("en", "020 7946 0958"), ("de", "+65 1234 5678")])
def test_telephones_of_each_locale(spark, lang, phone):
    x = f"Ruf {phone} an, a@b.example 10.0.0.1 bitte"
    rows = pii.find_pii(_docs(spark, x, lang=lang)).orderBy("start").collect()
    assert [(r.kind, r.start, r.value) for r in rows] == [
        ("PHONE", 4, phone), ("EMAIL", x.index("a@b"), "a@b.example"), ("IP", x.index("10.0"), "10.0.0.1")]
    assert pii.redact_pii(_docs(spark, x, lang=lang)).first().text == "Ruf [PHONE] an, [EMAIL] [IP] bitte"


def test_languages_without_a_list_are_not_judged(spark):
    df = spark.createDataFrame([(1, "en", "you idiot there"), (2, "xx", "you idiot there"), (3, None, "worthless")], "doc_id long, lang string, text string")
    terms = spark.createDataFrame([("en", "Idiot", "mild"), ("en", "worthless", "severe")], "lang string, term string, severity string")
    for listed in (toxicity.TERMS, terms):
        got = {r.doc_id: r for r in toxicity.toxic_density(df, listed).collect()}
        assert (got[1].n_terms, got[1].dropped) == (1, True)
        assert got[2].n_terms is None and got[2].density is None and got[2].dropped is None and got[3].dropped is None


def test_null_rules_do_not_fail(spark):
    df = spark.createDataFrame([("en", 5, 1), ("fr", 7, None), ("fr", 9, 0)], "lang string, n_chars int, x int")
    r = filters.filter_report(df, {"x": F.col("x") == 1}, ["lang"]).where("lang = 'fr'").first()
    assert (r.n_rows, r.n_kept, r.n_failed, r.chars_lost) == (2, 1, 1, 9)
