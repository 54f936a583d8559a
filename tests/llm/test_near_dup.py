import itertools
import random

import numpy as np
import pytest

from plateworks.llm import common, minhash, near_dup
from plateworks.llm.common import components, filter_place, id_filter


def brute(rows):
    def shingled(text):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for c in "\t\n\x0b\x0c\r":
            w = w.replace(c, " ")
        w = [x for x in w.split(" ") if x]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets = {d: shingled(t) for d, t in rows}
    label = {d: d for d in sets}
    find = lambda d: d if label[d] == d else find(label[d])
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            label[y] = x
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def corpus(seed=3):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    rows, n = [], 0
    base = rng.choices(words, k=120)
    for _ in range(150):  # edited copies of one text, many of them just below or above the limit
        copy = base[:]
        for _ in range(rng.randint(0, 8)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append((n, " ".join(copy)))
        n += 1
    passage = rng.choices(words, k=60)
    for _ in range(100):  # one passage in otherwise different texts
        rows.append((n, " ".join(rng.choices(words, k=120) + passage)))
        n += 1
    for _ in range(60):
        rows.append((n, rows[rng.randrange(len(rows))][1].upper()))
        n += 1
    return rows + [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, "one two"), (n + 4, "One  two"), (n + 5, "one two three"), (n + 6, "É one two  x y"), (n + 7, "é one two  x y")]


@pytest.mark.parametrize("region", [2048, 64])
def test_components_match_brute_force(spark, monkeypatch, region):
    rows = corpus()
    monkeypatch.setattr(minhash, "REGION", region)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(rows)


def test_pairs_in_a_hot_family_of_unlinked_texts(spark, monkeypatch):
    """All share a long passage (similarity 0.65, no link); some pairs share a little more (0.77)."""
    monkeypatch.setattr(minhash, "REGION", 6)
    passage = [f"p{k}" for k in range(204)]
    own = lambda d, n: [f"d{d}x{k}" for k in range(n)]
    pair = lambda d: own(1000 + d // 2, 21) + own(d, 33) if d < 120 else own(d, 54)
    rows = [(d, " ".join(passage + pair(d))) for d in range(200)]
    want = brute(rows)
    assert len({c for _, c, _ in want.values()}) == 140
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want


def test_one_dense_region(spark, monkeypatch):
    monkeypatch.setattr(minhash, "REGION", 8)
    base = [f"v{k}" for k in range(400)]
    rows = [(k, " ".join(base[:-1] + [f"end{k}"])) for k in range(60)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0}


def test_nulls_repeats_and_clashing_columns(spark):
    text = "a b c d e f g h"
    rows = [(3, text, 1), (3, text, 2), (None, text, 3), (1, text, 4), (None, None, 5)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, component_id int")).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [(-1, -1, True), (-1, -1, True), (1, 1, True), (3, 1, False), (3, 1, False)]
    assert near_dup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    kept = near_dup.keep_first(spark.createDataFrame(rows, "doc_id long, text string, fp int"))
    assert kept.columns == ["doc_id", "text", "fp"] and sorted(r.fp for r in kept.collect()) == [3, 4, 5]


@pytest.mark.parametrize("most", [500_000, 10])
def test_components_of_a_path_and_a_star(spark, monkeypatch, most):
    monkeypatch.setattr(common, "TASK_LINKS", most)
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(5, 5), (None, 4)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in range(101, 161)} == {100} and {got[k] for k in range(200, 260)} == {7} and len(got) == 60 + 60


def test_id_filter_has_no_misses(spark):
    ids = spark.range(1, 5000, 7)
    bits = np.frombuffer(id_filter(ids), np.uint8)
    at = np.array([r.p for r in ids.select(filter_place("id").alias("p")).collect()])
    assert ((bits[at >> 3] >> (at & 7)) & 1).all() and np.unpackbits(bits).sum() <= len(at)


def test_bands_reach_the_recall():
    bands, rows = minhash.tune_bands(0.75, 0.9998)
    assert 1 - (1 - 0.75**rows) ** bands >= 0.9998 and bands * rows <= minhash.HASHES


def test_one_id_with_two_texts(spark):
    a, b = "a b c d e f g h i j", "q r s t u v w x y z"
    for rows in ([(5, a), (5, b), (7, b), (9, a)], [(9, a), (7, b), (5, b), (5, a)]):
        got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert sorted((r.doc_id, r.component_id) for r in got) == [(5, 5), (5, 5), (7, 5), (9, 5)]


def test_a_set_of_very_many_shingles(spark):
    long = [f"z{k}" for k in range(60_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:-500])), (3, " ".join(long[:30_000])), (4, "x" * 200_000), (5, "x" * 200_001)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}
