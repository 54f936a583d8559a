import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from plateworks.llm import mixing

DATA = "/root/testdata/sf0.01"


def test_raking_meets_targets_and_bounds():
    rng = np.random.default_rng(1)
    w = rng.uniform(50, 100, (4, 3, 2))
    goal = [w.sum(axis=(1, 2)) * 0.5 * f for f in [np.array([0.9, 1.1, 1.0, 1.0])]]
    goal.append(np.full(3, goal[0].sum() / 3))
    goal.append(np.array([0.45, 0.55]) * goal[0].sum())
    s = mixing.rake(w, goal)
    assert (s > 0).all() and (s <= 1).all()
    for axis, target in enumerate(goal):
        assert np.allclose((w * s).sum(axis=tuple(k for k in range(3) if k != axis)), target, rtol=1e-6)
    # plain proportional fitting, cell by cell, gives the same where no bound binds
    x = w.copy()
    for _ in range(500):
        for a in range(4):
            x[a] *= goal[0][a] / x[a].sum()
        for b in range(3):
            x[:, b] *= goal[1][b] / x[:, b].sum()
        for c in range(2):
            x[:, :, c] *= goal[2][c] / x[:, :, c].sum()
    assert np.allclose(w * s, x, rtol=1e-6)


def test_unreachable_targets_stay_in_bounds():
    s = mixing.rake(np.array([[1.0, 0.0], [0.0, 9.0]]), [np.array([5.0, 5.0]), np.array([5.0, 5.0])])
    assert (s <= 1).all() and s[0, 0] == 1


def test_nulls_and_clashes(spark):
    rows = [(1, "a b c", "en", "src0", 1), (1, "a b c", "en", "src0", 1), (2, None, None, None, 1), (None, "", "xx", "src1", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, topic int")
    got = mixing.mix(docs).collect()
    assert sorted(r["_tokens"] for r in got) == [1, 1, 3, 3] and len({r["_taken"] for r in got if r.doc_id == 1}) == 1
    assert mixing.sample(docs).columns == docs.columns and mixing.mix(docs.limit(0)).count() == 0


def test_kept_share_is_lowered_until_targets_are_met():
    cells = {("src0", "en", "long"): 50.0, ("src0", "de", "prose"): 50.0, ("src1", "en", "long"): 450.0, ("src1", "de", "prose"): 450.0}
    targets = {"source": {"src0": 0.5, "src1": 0.5, "gone": 0.2}, "lang": {"en": 0.5, "de": 0.5}, "topic": {"long": 0.5, "prose": 0.5}}
    found = mixing.calibrate(cells, targets, 0.7)
    assert found.residual <= mixing.TOLERANCE and 0.15 < found.keep < 0.21 and found.chances["src0", "en", "long"] > 0.9
    assert mixing.calibrate(cells, targets, 0.1).keep == 0.1
    never = {"source": {"src0": 0.5, "src1": 0.5}, "lang": {"en": 0.9, "de": 0.1}, "topic": {"long": 0.1, "prose": 0.9}}
    with pytest.raises(ValueError):
        mixing.calibrate(cells, never, 0.5, strict=True)
    with pytest.warns(UserWarning):
        assert mixing.calibrate(cells, never, 0.5).residual > 0.1
    assert mixing.calibrate({}, targets, 0.5).residual == 0


def test_long_texts_and_columns_named_like_ours(spark):
    rows = [(d, "word " * (200_000 if d == 1 else 5), "en", "src0", d, d, d, "x") for d in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _taken int, _cell int, _probability int, _mix_of string")
    got = mixing.sample(docs)
    assert got.columns == docs.columns and all(r["_taken"] == r["_cell"] == r["_probability"] == r.doc_id and r["_mix_of"] == "x" for r in got.collect())
    assert {r.doc_id: r.n_tokens for r in mixing.measure(docs).collect()}[1] > 199_999


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_query_matches_brute_force(spark):
    """Cells, probabilities by plain proportional fitting with bounds, marginals and draws."""
    got = mixing.op4_mixing(spark, DATA).toPandas()
    docs = spark.read.parquet(f"{DATA}/documents.parquet").toPandas().set_index("doc_id").loc[got.doc_id]
    named = lambda c, axis: c if c in mixing.TARGETS[axis] else "other"
    assert list(got.source) == [named(c, "source") for c in docs.source] and list(got.lang) == [named(c, "lang") for c in docs.lang]
    form = lambda t: "short" if len(t) < 300 else "lines" if len(t) < 80 * (t.count("\n") + 1) else "long" if len(t) > 6000 else "prose"
    assert list(got.topic) == [named(form(t), "topic") for t in docs.text]
    total, kept = got.n_tokens.sum(), (got.n_tokens * got.probability).sum()
    scale = {}
    goal = {}
    for axis in ("source", "lang", "topic"):
        sums = got.groupby(axis).n_tokens.sum()
        part = {c: t for c, t in mixing.TARGETS[axis].items() if sums.get(c, 0) > 0}
        free = sums.get("other", 0) / total
        goal[axis] = {c: t / sum(part.values()) * (1 - free) for c, t in part.items()} | ({"other": free} if free else {})
        mixed = (got.n_tokens * got.probability).groupby(got[axis]).sum() / kept
        assert all(abs(mixed[c] - t) < 0.01 for c, t in goal[axis].items())
    cells = got.groupby(["source", "lang", "topic"]).n_tokens.sum().to_dict()
    scale = dict.fromkeys(cells, 1.0)
    keep = mixing.calibrate({c: float(n) for c, n in cells.items()}, mixing.TARGETS, mixing.KEEP).keep
    for _ in range(mixing.ROUNDS):
        for k, axis in enumerate(("source", "lang", "topic")):
            for c, t in goal[axis].items():
                own = [x for x in cells if x[k] == c]
                factor = t * keep * total / sum(cells[x] * scale[x] for x in own)
                scale.update({x: min(1.0, scale[x] * factor) for x in own})
    assert all(abs(p - scale[c]) < 1e-6 for c, p in zip(zip(got.source, got.lang, got.topic), got.probability))
    draws = {r.doc_id: r.x for r in spark.createDataFrame([(int(d),) for d in got.doc_id], "doc_id long").selectExpr("doc_id", "shiftrightunsigned(xxhash64(17, doc_id), 11) / 9007199254740992D x").collect()}
    assert list(got.taken) == [draws[d] < p for d, p in zip(got.doc_id, got.probability)]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    targets = {"source": {f"src{k}": 1 for k in range(20)}, "lang": {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}, "topic": {"long": 0.4, "prose": 0.4}}
    out = mixing.mix(docs, targets, keep=0.3).cache()
    total = out.agg(F.sum("_tokens")).first()[0]
    want = {r[0]: r[1] for r in out.groupBy("lang").agg(F.sum(F.col("_tokens") * F.col("_probability"))).collect()}
    assert abs(want["en"] - 0.5 * 0.3 * total) < 0.01 * total
    taken = out.where("_taken").agg(F.sum("_tokens")).first()[0]
    assert 0.2 * total < taken < 0.4 * total
    brute = sum((r.text or "").count(" ") + (r.text or "").count("\n") + 1 for r in docs.collect())
    assert brute == total


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_weights_are_the_tokens_of_the_library(spark):
    from tokenizers import Tokenizer

    from plateworks.llm.tokens import default_tokenizer

    library = Tokenizer.from_file(default_tokenizer())
    library.encode_special_tokens = True
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = mixing.op4_mixing(spark, DATA).collect()
    want = {d: max(1, len(library.encode(t, add_special_tokens=False).ids)) for d, t in texts.items()}
    assert {r.doc_id: r.n_tokens for r in got} == want and len(got) == docs.count()
    # The share of English among the languages with a target, in real tokens.
    sums = {k: sum(r.n_tokens * r.probability for r in got if r.lang == k) for k in mixing.TARGETS["lang"]}
    assert abs(sums["en"] / sum(sums.values()) - mixing.TARGETS["lang"]["en"]) < 0.005
    taken = {r.doc_id for r in mixing.sample(docs).collect()}
    assert taken == {r.doc_id for r in got if r.taken}
