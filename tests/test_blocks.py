"""Blocks of queries against parts of references: what leaves a task is bounded, and equals plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plateworks.operators import blocks, neighbours


def spread(spark, n, copies=0, seed=5, width=12):
    rows = np.random.default_rng(seed).normal(size=(n, width))
    rows[n - copies :] = rows[3]
    df = spark.createDataFrame([(2 * k, [float(x) for x in v]) for k, v in enumerate(rows)], "id long, v array<double>")
    return rows, df.repartition(3)


@pytest.mark.parametrize("block,others,copies", [(blocks.BLOCK, True, 40), (50, True, 0), (50, False, 40)])
def test_nearest_leave_tasks_as_k_rows_a_query(spark, monkeypatch, block, others, copies):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    rows, df = spread(spark, 400, copies)
    k, asked = 5, df.where("id % 4 = 0")
    left = neighbours._search(asked, df, "id", "v", k, 16, 50, False, others)
    n_blocks, parts = blocks.grid(200, spark, block)
    assert n_blocks == -(-200 // block) and left.count() <= 200 * k * parts
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    d = np.round(1 - unit @ unit.T, 9)
    want = {}
    for q in range(0, 400, 2):
        near = sorted((r for r in range(400) if not others or r != q), key=lambda r: (d[q, r], r))[:k]
        want |= {(2 * q, 2 * r): place for place, r in enumerate(near, 1)}
    got = neighbours.nearest_pruned(asked, df, "id", "v", k, 16, 50, others).collect()
    assert {(r.query_id, r.ref_id): r.rank for r in got} == want
    # Distances are whole, not cut to nine digits: a query that rounds them rounds once.
    assert all(abs(r.cosine_dist - (1 - unit[r.query_id // 2] @ unit[r.ref_id // 2])) < 1e-14 for r in got)


def test_nearest_with_other_ids(spark):
    _, df = spread(spark, 60)
    named = df.select(F.concat(F.lit("c"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("id"), "v")
    number = lambda found: {(int(str(r.query_id).lstrip("c")), int(str(r.ref_id).lstrip("c")), r.rank) for r in found.collect()}
    assert number(neighbours.nearest_pruned(named, named, "id", "v", 4)) == number(neighbours.nearest_pruned(df, df, "id", "v", 4))
    assert neighbours.nearest_pruned(df, df.where("id < 0"), "id", "v", 4).count() == 0


def test_no_query_joins_all_pairs(spark):
    from plateworks.plans import catalog

    for name in ("cosine_topk", "rank_first", "rank_min_ties", "tanimoto_rank", "rank_compare", "rank_compare_three"):
        plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "NestedLoop" not in plan and "Cartesian" not in plan, name


@pytest.mark.parametrize("block", [blocks.BLOCK, 7])
def test_counted_ranks_equal_sorted_ones(spark, monkeypatch, block):
    from plateworks.operators import bitranks

    monkeypatch.setattr(bitranks.blocks.grid, "__defaults__", (block,))
    _, df = spread(spark, 120, 15, width=8)
    df = df.unionByName(spark.createDataFrame([(1001, [-1.0] * 8), (1003, [-2.0] * 8), (1005, None)], df.schema))
    sets = {r.id: None if r.v is None else {k for k, x in enumerate(r.v) if x > 0} for r in df.collect()}
    far = lambda a, b: 9.0 if sets[a] is None or sets[b] is None else 1 - (len(sets[a] & sets[b]) / len(sets[a] | sets[b]) if sets[a] | sets[b] else 1)
    asked = [q for q in sets if q % 12 == 0 or q > 1000]
    queries = df.where("id % 12 = 0 or id > 1000")
    first, least = {}, {}
    for q in asked:
        rows = sorted((far(q, r), r) for r in sets if r != q)
        first |= {(q, r): k for k, (_, r) in enumerate(rows, 1)}
        least |= {(q, r): 1 + sum(x < d for x, _ in rows) for d, r in rows}
    found = lambda df: {(r.query_id, r.ref_id): r["rank"] for r in df.collect()}
    assert found(bitranks.bit_ranks(queries, df, "id", "v")) == first
    assert found(bitranks.bit_ranks(queries, df, "id", "v", shared=True)) == least
    top = bitranks.bit_ranks(queries, df, "id", "v", shared=True, most=5).collect()
    assert {(r.query_id, r.ref_id): r["rank"] for r in top} == {p: k for p, k in least.items() if k <= 5}
    assert all(r.jaccard_dist == (None if (d := far(r.query_id, r.ref_id)) == 9 else d) for r in top)


@pytest.mark.parametrize("block", [blocks.BLOCK, 9])
def test_compared_metrics_equal_loops(spark, monkeypatch, block):
    from plateworks.operators import compare

    monkeypatch.setattr(compare.blocks.grid, "__defaults__", (block,))
    rows, df = spread(spark, 150, 12, width=10)
    names, most = ["cosine", "jaccard", "tanimoto"], 3
    g, bits = rows @ rows.T, (rows > 0).astype(float)
    square, shared, ones = np.diag(g), bits @ bits.T, bits.sum(axis=1)
    d = {"cosine": 1 - g / np.sqrt(np.outer(square, square)), "jaccard": 1 - shared / (ones[:, None] + ones - shared), "tanimoto": g / (square[:, None] + square - g)}
    want = {}
    for q in range(0, 150, 5):
        rank = {m: {r: k for k, r in enumerate(sorted((r for r in range(150) if r != q), key=lambda r: (round(d[m][q, r], 9), r)), 1)} for m in names}
        want |= {(2 * q, 2 * r): tuple(rank[m][r] for m in names) for r in rank["cosine"] if min(rank[m][r] for m in names) <= most}
    got = compare.compare_vectors(df.where("id % 10 = 0"), df, "id", "v", names, most).collect()
    assert {(r.query_id, r.ref_id): (r.cosine_rank, r.jaccard_rank, r.tanimoto_rank) for r in got} == want and len(got) == len(want)
    assert all(abs(r[f"{m}_dist"] - d[m][r.query_id // 2, r.ref_id // 2]) < 1e-12 for r in got for m in names)


def test_nearest_of_every_row_equals_loops(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "FIRST", 24)
    monkeypatch.setattr(neighbours, "ROUGH", 500)
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(150, 6)).astype(np.float32)
    rows[40:70] = rows[40]  # copies, more than the neighbours wanted
    rows[70:80] = rows[40] * np.float32(1 + 1e-6) + np.float32(1e-6)
    for kind in ("float", "double"):
        df = spark.createDataFrame([(k * 2, [float(x) for x in v]) for k, v in enumerate(rows)] + [(999, None), (1001, [0.0] * 6)], f"id long, v array<{kind}>").repartition(3)
        v = rows.astype(float)
        norm = np.sqrt((v * v).sum(axis=1))
        d = 1 - v @ v.T / np.outer(norm, norm)
        np.fill_diagonal(d, np.inf)
        for k in (1, 7, 200):
            got = {r.query_id // 2: [x.ref_id // 2 for x in r.near] for r in neighbours.nearest_lists(df, "id", "v", k).collect()}
            assert got.keys() == set(range(150)) and all(len(x) == min(k, 149) for x in got.values())
            want = {i: set(sorted(range(150), key=lambda j: (round(d[i, j], 9), j))[: min(k, 149)]) for i in range(150)}
            assert all(set(got[i]) == want[i] for i in want)
