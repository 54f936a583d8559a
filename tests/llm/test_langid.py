import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from plateworks.llm import langid

DATA = "/root/testdata/sf0.01"
TEXTS = {"en": "the house and the garden were with this water over there", "de": "das Haus und der Garten waren mit diesem Wasser über dort"}


def small_model(spark):
    rows = [(k, TEXTS[lang], lang) for k, lang in enumerate(["en", "de"] * 5)] + [(99, None, "en"), (98, "x", None)]
    return langid.fit_text_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, declared string, suffix string, host string, language int")


def test_fusion_matches_bayes_by_hand(spark):
    model = small_model(spark)
    rows = [(1, "the water", "de", "com", "a", 1), (2, "der Garten", None, "de", "b", 1), (3, "das Haus", "xx", None, "b", 1), (4, "zzz", "en-GB", "fr", None, 1), (5, None, "de", "de", "b", 1), (6, "", None, None, None, 1), (None, "!!! 12", None, None, "a", 1), (2, "der Garten", None, "de", "b", 1)]
    docs = frame(spark, rows)
    got = langid.identify(docs, model, docs["declared"], docs["suffix"], docs["host"]).collect()
    assert len(got) == len(rows)
    langs = model.languages
    info = []
    for d, text, declared, suffix, host, _ in rows:
        g, n = model.gains(text or "")
        known = n >= langid.LEAST_TRIGRAMS and g.max() / n > langid.LEAST_GAIN
        info.append((d, g * langid.TEMPER, known, declared, suffix, host or "", int(np.argmax(g)) if known else None))
    total = np.array([1.0 + sum(i[6] == k for i in info) for k in range(len(langs))])
    total /= total.sum()
    for d, g, known, declared, suffix, host, best in info:
        s = np.array([sum(i[6] == k and i[4] == suffix for i in info) for k in range(len(langs))]) + langid.SUFFIX_WEIGHT * total
        h = np.array([sum(i[6] == k and i[4] == suffix and i[5] == host for i in info) for k in range(len(langs))])
        prior = (h + langid.HOST_WEIGHT * s / s.sum()) / (h.sum() + langid.HOST_WEIGHT)
        score = np.log(prior) + (g if known else 0)
        for says, p in ((declared and declared[:2].lower(), langid.DECLARED_RIGHT), (langid.SUFFIX_LANGUAGE.get(suffix), langid.SUFFIX_RIGHT)):
            if says in langs:
                score += np.log([p if x == says else (1 - p) / (len(langs) - 1) for x in langs])
        want = np.exp(score - score.max())
        want /= want.sum()
        match = [r for r in got if r.doc_id == d]
        assert match and abs(match[0].posterior - want.max()) < 1e-9
        assert match[0].language == (langs[int(np.argmax(score))] if known else "und") and match[0].accepted == bool(known and want.max() >= langid.LEAST_POSTERIOR)
    assert langid.identify(docs.limit(0), model, docs["declared"], docs["suffix"], docs["host"]).count() == 0


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rest = docs.where(F.col("doc_id") % 2 == 1)
    model = langid.fit_text_model(docs.where(F.col("doc_id") % 2 == 0), sample=50)
    # Running text: of characters that are no white space, few are symbols.
    solid = F.regexp_replace("text", r"\s", "")
    running = F.length(F.regexp_replace(solid, r"[#*$%&|<>{}\[\]^~\\=@_+/]", "")) > 0.85 * F.length(solid)
    out = langid.identify(rest, model, F.lit(None), F.lit(None), rest["source"]).join(rest.where(running).select("doc_id", "lang"), "doc_id")
    n, right, kept = out.agg(F.count("*"), F.avg((F.col("text_language") == F.col("lang")).cast("double")), F.avg(F.col("accepted").cast("double"))).first()
    assert n > 400 and right > 0.97 and kept > 0.97
    pages = langid.identify_pages(spark.read.parquet(f"{DATA}/pages.parquet"), model).where("accepted").count()
    assert pages > 200


def test_very_short_texts_are_judged_by_all_evidence(spark):
    model = small_model(spark)
    docs = frame(spark, [(1, "the", "en", None, "a", 1), (2, "A.", "en", None, "a", 1), (3, "12 34", "en", None, "a", 1)])
    got = {r.doc_id: r for r in langid.identify(docs, model, docs["declared"], docs["suffix"], docs["host"]).collect()}
    assert got[1].accepted and got[1].language == "en" and not got[3].accepted and got[3].language == "und"


def test_labels_of_any_form(spark):
    rows = [(k, TEXTS["en"] if k % 2 else TEXTS["de"], ["EN", "x.y", " en", "x.y"][(k % 2 == 0) + 2 * (k % 4 > 1)]) for k in range(12)]
    docs = spark.createDataFrame([(d, t, label, "h`o.st") for d, t, label in rows], "doc_id long, text string, lang string, source string")
    assert langid.fit_text_model(docs).languages == ["en", "x.y"]
    got = {r.doc_id: r.language for r in langid.identify_documents(docs).collect()}
    assert got == {d: "en" if d % 2 else "x.y" for d in range(12)}


def test_very_long_and_repeated_texts(spark):
    docs = frame(spark, [(1, TEXTS["de"] * 20_000, None, None, "a", 1)] * 2 + [(2, "x" * 300_000, "en", None, "a", 1)])
    got = langid.identify(docs, small_model(spark), docs["declared"], docs["suffix"], docs["host"]).collect()
    assert [(r.doc_id, r.language) for r in got if r.doc_id == 1] == [(1, "de")] * 2 and len(got) == 3


def symbol_share(text):
    solid = "".join((text or "").split())
    return sum(c in langid.SYMBOLS for c in solid) / max(1, len(solid))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_junk_is_rejected_and_running_text_kept(spark):
    """Held out: the model sees documents of even id, the others are judged; junk is told by its share of symbols."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rest = docs.where(F.col("doc_id") % 2 == 1)
    model = langid.fit_text_model(docs.where(F.col("doc_id") % 2 == 0))
    verdicts = {r.doc_id: r for r in langid.identify(rest, model, rest["lang"], F.lit(None), rest["source"]).collect()}
    rows = rest.select("doc_id", "text", "lang").collect()
    junk = [r for r in rows if symbol_share(r.text) >= 0.25]
    clean = [r for r in rows if symbol_share(r.text) < 0.15]
    assert len(junk) > 50 and len(clean) > 4000
    assert sum(not verdicts[r.doc_id].accepted for r in junk) >= 0.95 * len(junk)
    assert sum(verdicts[r.doc_id].accepted for r in clean) >= 0.999 * len(clean)
    assert sum(verdicts[r.doc_id].text_language == r.lang for r in clean) >= 0.99 * len(clean)
    noise = spark.createDataFrame([(k, "".join(chr(97 + (k * 31 + j * j * 17 + j * 7) % 26) for j in range(300))) for k in range(20)], "doc_id long, text string")
    assert not any(r.accepted for r in langid.identify(noise, model, F.lit("en"), F.lit(None), F.lit("src1")).collect())


def test_more_labels_than_columns(spark):
    rows = [(k, TEXTS["en"], "en", "h") for k in range(40)] + [(100 + k, TEXTS["de"], f"l{k:03d}", "h") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = langid.fit_text_model(docs)
    assert len(model.languages) == langid.LANGUAGES and "en" in model.languages and langid.OTHER in model.languages
    got = langid.identify_documents(docs).collect()
    assert len(got) == 340 and all(r.language == "en" for r in got if r.doc_id < 100)
