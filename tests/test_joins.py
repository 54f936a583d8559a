"""Nearest-time joins, pruned neighbours and joins of bit sets equal plain loops."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plateworks.operators import similarity
from plateworks.operators.asof import nearest_time_join
from plateworks.operators.bitjoin import similar_sets
from plateworks.operators.neighbours import compared_pairs, nearest_pruned


def plain_asof(left, right, how, within):
    out = []
    for row in left:
        k, t = row[1], row[2]
        near = [(abs(r[2] - t), r) for r in right if t is not None and k is not None and r[1] == k and r[2] is not None and (how == "nearest" or (r[2] <= t if how == "backward" else r[2] >= t))]
        least = min((d for d, _ in near), default=None)
        found = [r for d, r in near if d == least and (within is None or d <= within)]
        out += [(*row, *r) for r in found] or [(*row, None, None, None)]
    return out


@pytest.mark.parametrize("how", ["nearest", "backward", "forward"])
@pytest.mark.parametrize("within", [None, 2.0])
def test_nearest_time(spark, how, within):
    rng = random.Random(f"{how}{within}")
    row = lambda k: (k, rng.choice(["a", "a", "a", "b", "c", None]), rng.choice([None, *map(float, range(0, 60, 3)), rng.randrange(60) + 0.5]))
    left, right = [row(k) for k in range(150)] + [(900, "zz", 5.0)], [row(k) for k in range(60)] + [(901, "only", 1.0)]
    schema = "id int, g string, t double"
    got = nearest_time_join(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), "t", "t", {"g": "g"}, how, within, parts=7)
    assert got.columns == ["id", "g", "t", "near_id", "near_g", "near_t"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain_asof(left, right, how, within)))


def test_nearest_timestamps_without_groups(spark):
    day = lambda d, h=0: datetime.datetime(2024, 1, d, h)
    left = spark.createDataFrame([(1, day(1)), (2, day(5, 12)), (3, day(30))], "id int, t timestamp")
    right = spark.createDataFrame([(7, day(5)), (8, day(6)), (9, day(6))], "id int, t timestamp")
    got = {(r.id, r.near_id) for r in nearest_time_join(left, right, "t", "t").collect()}
    assert got == {(1, 7), (2, 7), (2, 8), (2, 9), (3, 8), (3, 9)}
    none = nearest_time_join(left, right.where("id > 99"), "t", "t").collect()
    assert sorted((r.id, r.near_id) for r in none) == [(1, None), (2, None), (3, None)]


def vectors(spark, centres, each, spread, seed):
    rng = np.random.default_rng(seed)
    at = rng.normal(size=(centres, 16))
    rows = np.concatenate([c + spread * rng.normal(size=(each, 16)) for c in at])
    rows[5] = rows[4]
    return rows, spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(rows)] + [(10**6, [0.0] * 16), (10**6 + 1, None)], "id long, v array<double>")


@pytest.mark.parametrize("centres,each,spread,share,cell_rows", [(30, 60, 0.05, 1 / 3, 50_000), (30, 60, 0.05, 1 / 3, 20), (2, 200, 1.0, 1.01, 50)])
def test_neighbours_equal_all_pairs(spark, centres, each, spread, share, cell_rows):
    rows, df = vectors(spark, centres, each, spread, 3)
    queries, k = df.where("id % 50 = 0 or id = 1000001"), 7
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    asked = [q for q in range(len(rows)) if q % 50 == 0]
    want = set()
    for q in asked:
        d = np.round(1 - unit @ unit[q], 9)
        want |= {(q, int(r)) for r in sorted(range(len(rows)), key=lambda r: (d[r], r))[:k]}
    got = nearest_pruned(queries, df, "id", "v", k, 32, cell_rows).collect()
    found = {(r.query_id, r.ref_id) for r in got}
    # Equal rows have one distance but for rounding.
    far = {(q, r) for q, r in found ^ want if abs((1 - unit[r] @ unit[q]) - sorted(1 - unit @ unit[q])[k - 1]) > 1e-8}
    assert not far and len(found) == len(want)
    pairs = compared_pairs(queries, df, "id", "v", k, 32, cell_rows)
    assert pairs.count() < share * len(asked) * len(rows)
    assert pairs.select("query_id", "ref_id").distinct().count() == pairs.count()
    assert "CartesianProduct" not in pairs._jdf.queryExecution().toString()


@pytest.mark.parametrize("limit,postings,apart", [(0.5, 20_000, 1), (0.8, 3, 1), (1.0, 20_000, 1), (0.01, 5, 1), (0.4, 7, 5)])
def test_similar_sets(spark, limit, postings, apart):
    rng = random.Random(4)
    base = [set(rng.sample(range(40), rng.randrange(1, 15))) for _ in range(20)]
    sets = [b ^ set(rng.sample(range(40), rng.randrange(0, 4))) for b in base for _ in range(5)] + [set(), {39}, {39}]
    df = spark.createDataFrame([(k, [apart * b for b in sorted(s)]) for k, s in enumerate(sets)] + [(10**6, None)], "id long, bits array<int>")
    pairs = similar_sets(df, "id", F.col("bits"), limit, 40 * apart, postings)
    assert "Cartesian" not in pairs._jdf.queryExecution().toString()
    got = pairs.collect()
    want = {}
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            if (len(x), i) < (len(y), j) and x and len(x & y) / len(x | y) >= limit:
                want[i, j] = len(x & y) / len(x | y)
    assert len(got) == len(want) and {(r.first_id, r.second_id): r.similarity for r in got} == pytest.approx(want)


def test_ranks_over_ranges_and_top_rows(spark):
    rng = random.Random(1)
    rows = [(q, r, round(rng.random(), 1), round(rng.random(), 1)) for q in (1, 2, 3) for r in range(60)]
    df = spark.createDataFrame(rows, "query_id long, ref_id long, a_dist double, b_dist double")
    place = lambda q, r, k: 1 + sum((x[k], x[1]) < (v, r) for x in rows if x[0] == q for v in [next(y[k] for y in rows if y[0] == q and y[1] == r)])
    want = {(q, r): (place(q, r, 2), place(q, r, 3)) for q, r, _, _ in rows}
    every = {(x.query_id, x.ref_id): (x.a_rank, x.b_rank) for x in similarity.compare_metrics(df, ["a", "b"]).collect()}
    assert every == want
    top = {(x.query_id, x.ref_id): (x.a_rank, x.b_rank) for x in similarity.compare_top(df, ["a", "b"], 4).collect()}
    assert top == {k: v for k, v in want.items() if min(v) <= 4}
    shared = {(x.query_id, x.ref_id): x.rank for x in similarity.full_ranks_shared(df, "a_dist", "rank").collect()}
    assert shared == {(q, r): 1 + sum(x[0] == q and x[2] < a for x in rows) for q, r, a, _ in rows}


def test_dense_sets_leave_tasks_as_results_only(spark):
    rng = random.Random(9)
    sets = [{b for b in range(64) if rng.random() < 0.5} for _ in range(300)]
    df = spark.createDataFrame([(k, sorted(s)) for k, s in enumerate(sets)], "id long, bits array<int>")
    for postings in (4096, 11):
        pairs = similar_sets(df, "id", F.col("bits"), 0.55, 64, postings)
        assert "MapInArrow" in pairs._jdf.queryExecution().executedPlan().toString()
        want = {(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets) if (len(x), i) < (len(y), j) and len(x & y) / len(x | y) >= 0.55}
        got = [(r.first_id, r.second_id) for r in pairs.collect()]
        assert set(got) == want and len(got) == len(want)
