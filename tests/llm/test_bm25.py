import math
import random

import numpy as np
import pyarrow as pa
import pytest

from plateworks.llm import bm25


def brute(rows, queries, top):
    docs = [(d, (t or "").lower().split()) for d, t in rows if d is not None]
    n, average = len(docs), sum(len(w) for _, w in docs) / len(docs)
    df = {}
    for _, w in docs:
        for x in set(w):
            df[x] = df.get(x, 0) + 1
    out = {}
    for q, text in queries:
        scored = []
        for d, w in docs:
            s = 0.0
            for x in set((text or "").lower().split()) & set(w):
                tf = w.count(x)
                s += math.log(1 + (n - df[x] + 0.5) / (df[x] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / average))
            if s > 0 and d != q:
                scored.append((-round(s, 6), d))
        out[q] = [(r + 1, d, -s) for r, (s, d) in enumerate(sorted(scored)[:top])]
    return out


@pytest.mark.parametrize("shard,block", [(4096, 32), (50, 4), (7, 1)])
def test_results_match_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(bm25, "SHARD_DOCS", shard)
    monkeypatch.setattr(bm25, "BLOCK", block)
    rng = random.Random(2)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(20000)]
    rows = [(d, " ".join(rng.choices(words, k=rng.choice([3, 20, 60, 300])))) for d in range(300)]
    rows += [(d + 300, rows[d][1]) for d in range(0, 60, 5)] + [(900, None), (901, ""), (None, "w1 w2"), (902, "w1 " * 30000)]
    queries = [(d, t) for d, t in rows if d is not None and d % 20 == 0] + [(5000, "W1 w2 unseen"), (5001, "unseen"), (None, "w1")]
    index = bm25.build_index(spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, terms int").repartition(3))
    got = {}
    for r in bm25.search(index, spark.createDataFrame(queries, "query_id long, text string"), 7).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.doc_id, r.score))
    want = {q: x for q, x in brute(rows, [q for q in queries if q[0] is not None], 7).items() if x}
    assert got.keys() == want.keys()
    for q in want:
        assert [x[:2] for x in got[q]] == [x[:2] for x in want[q]] and all(abs(x[2] - y[2]) < 2e-6 for x, y in zip(got[q], want[q]))


def test_pruning_skips_postings(monkeypatch):
    monkeypatch.setattr(bm25, "BLOCK", 4)
    rng = random.Random(4)
    rows = ["common " * rng.randint(1, 9) + f"x{k}" for k in range(400)]
    rows[7] = "rare common"
    terms, counts, cuts = bm25.term_sets(pa.array(rows))
    shard = bm25.Shard(bm25._packed(list(range(400)), [(terms[a:b], counts[a:b]) for a, b in zip(cuts, cuts[1:])]), 6.0)
    asked = bm25.term_sets(pa.array(["rare common"]))[0]
    ids, scores = shard.best(-1, asked, np.array([5.0, 5.0]), 1, np.empty(0, np.int64), np.empty(0))
    assert ids.tolist() == [7] and len(scores) == 1
    assert shard.read + shard.skipped == 401 and shard.read < 200  # of the 401 postings of the two words


def test_queries_of_a_block_are_searched_for_together():
    rng = random.Random(6)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(4000)]
    rows = [(d, " ".join(rng.choices(words, k=rng.choice([5, 40, 200])))) for d in range(900)]
    rows += [(d, rows[d][1]) for d in range(0, 90, 9)]  # repeated ids: a query leaves out all of its own
    average = sum(len(t.split()) for _, t in rows) / len(rows)
    df = {}
    for _, t in rows:
        for x in set(t.split()):
            df[x] = df.get(x, 0) + 1
    asked = [r for r in rows[:900] if r[0] % 9 == 0]
    terms, _, cuts = bm25.term_sets(pa.array([t for _, t in asked]))
    known = {int(bm25.term_sets(pa.array([x]))[0][0]): math.log(1 + (len(rows) - n + 0.5) / (n + 0.5)) for x, n in df.items()}
    distinct, of = np.unique(terms, return_inverse=True)
    queries = bm25.Queries(np.array([d for d, _ in asked]), cuts, distinct, np.array([known[int(t)] for t in distinct]), of)
    products = 0
    for some in (rows[:300], rows[300:]):
        t, c, ends = bm25.term_sets(pa.array([x for _, x in some]))
        shard = bm25.Shard(bm25._packed([d for d, _ in some], [(t[a:b], c[a:b]) for a, b in zip(ends, ends[1:])]), average)
        products += len(shard.matrix)
        assert shard.search(queries, 5).any()
    assert products  # both ways of scoring had a part
    want = brute(rows, asked, 5)
    for (q, _), (ids, scores) in zip(asked, queries.found):
        order = np.lexsort((ids, -scores))
        assert ids[order].tolist() == [x[1] for x in want[q]] and np.allclose(scores[order], [x[2] for x in want[q]], atol=2e-6)


def test_a_shard_that_cannot_serve_a_query_is_left_out():
    rows = ["rare word"] * 12 + [f"common x{k}" for k in range(500)]
    terms, counts, cuts = bm25.term_sets(pa.array(rows))
    found = [(terms[a:b], counts[a:b]) for a, b in zip(cuts, cuts[1:])]
    asked = bm25.term_sets(pa.array(["rare common"]))[0]
    queries = bm25.Queries(np.array([-1]), np.array([0, 2]), asked, np.where(asked == bm25.term_sets(pa.array(["rare"]))[0][0], 5.0, 0.1), np.arange(2))
    assert bm25.Shard(bm25._packed(list(range(12)), found[:12]), 2.0).search(queries, 10).any()
    assert not bm25.Shard(bm25._packed(list(range(12, 512)), found[12:]), 2.0).search(queries, 10).any()
    assert sorted(queries.found[0][0].tolist()) == list(range(10))


def test_documents_of_different_words_are_parts_of_their_own(monkeypatch):
    monkeypatch.setattr(bm25, "ALIKE_DOCS", 4)
    rows = ["the the cat", "der der hund"] * 6 + ["the odd odd odd"] + ["none"]
    terms, counts, cuts = bm25.term_sets(pa.array(rows))
    parts = list(bm25._alike(list(range(14)), [(terms[a:b], counts[a:b]) for a, b in zip(cuts, cuts[1:])]))
    assert sorted(sorted(p["doc_ids"].tolist()) for _, _, p in parts) == [[0, 2, 4, 6, 8, 10, 12], [1, 3, 5, 7, 9, 11], [13]]


def test_order_by_owner_and_hash():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 64, 500, dtype=np.uint64) & ~np.uint64(7)
    hashes[1::2] = hashes[::2] | rng.integers(0, 8, 250, dtype=np.uint64)  # many differ in their last bits only
    owner = np.sort(rng.integers(0, 9, 500))
    assert (hashes[bm25._by_owner(owner, hashes, 9)] == hashes[np.lexsort((hashes, owner))]).all()


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    index = bm25.build_index(empty)
    assert bm25.search(index, spark.createDataFrame([(1, "a")], "query_id long, text string")).count() == 0
    full = bm25.build_index(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    assert bm25.search(full, spark.createDataFrame([], "query_id long, text string")).count() == 0
