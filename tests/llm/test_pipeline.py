import os

import pytest

import corpus_pipeline
from plateworks.llm import langid, mixing, near_dup, packing, pii

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_pipeline_matches_its_stages_by_hand(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    accepted = {r.doc_id for r in langid.identify_documents(docs).collect() if r.accepted}
    kept = docs.where(docs.doc_id.isin(sorted(accepted)))
    from test_near_dup import brute

    heads = sorted(d for d, (_, _, keep) in brute([(d, rows[d].text) for d in accepted]).items() if keep)
    texts = {d: pii.replaced(pii.DEFAULT_KEY, rows[d].text)[0] for d in heads}
    masked = spark.createDataFrame([(d, texts[d], rows[d].lang, rows[d].source, len(texts[d])) for d in heads], docs.schema)
    taken = {r.doc_id for r in mixing.sample(masked).collect()}
    assert kept.count() >= len(heads) >= len(taken) > 0
    want = sorted((r.doc_id, r.doc_tokens) for r in packing.pack(masked.where(masked.doc_id.isin(sorted(taken)))).collect() if r.start == 0)
    got = corpus_pipeline.run(spark, DATA).collect()
    assert sorted((r.doc_id, r.doc_tokens) for r in got if r.start == 0) == want
    assert sum(r.length for r in got) == sum(n for _, n in want)


def test_stages_keep_columns_and_take_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, component_id int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).count() == 0


def test_nulls_pass(spark):
    rows = [(1, None, None, None, None), (None, "some words in here", "en", "s", 3), (2, "", "en", "src1", 0), (3, "the water and the house of the garden are here with me", "en", "src1", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).count()


def test_rows_of_one_id_and_clashing_columns(spark):
    """Rows are judged one by one; columns named like the stages' own come through as they were."""
    good = "the water and the house of the garden are here with me and all of the others"
    own = ["_rejected", "_gone", "key", "n", "name", "id", "component", "keep", "_taken", "_cell", "kept", "place", "posterior"]
    rows = [(1, good, "en", "src1", len(good)), (1, "12 34", "en", "src1", 5), (1, good, "en", "src1", len(good)), (4, "Frau Anna Müller ist hier und der Garten mit dem Haus", "de", "src2", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in own)
    docs = spark.createDataFrame([(*r, *(f"{c}{k}" for c in own)) for k, r in enumerate(rows)], schema)
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = spark.createDataFrame(stage(spark, docs, DATA).collect(), docs.schema)
        assert all(r[c][:-1] == c for r in docs.collect() for c in own)
        seen[name] = sorted((r.doc_id, r.text) for r in docs.collect())
        assert docs.count() <= before
    assert [d for d, _ in seen["language_id"]] == [1, 1, 4]  # the row without words goes, others of its id stay
    assert [d for d, _ in seen["near_dedup"]] == [1, 1, 4]
    assert "Anna" not in str(seen["pii_surrogates"]) and "Müller" not in str(seen["pii_surrogates"])
    assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).columns[0] == "doc_id"
