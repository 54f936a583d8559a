"""The embedding keeps neighbours, by a figure taken against all pairs, and is the same in two runs."""

import numpy as np
from pyspark.sql import functions as F

from plateworks.operators import embedding, features


def clustered(spark):
    rng = np.random.default_rng(7)
    rows = np.concatenate([c + 0.3 * rng.normal(size=(20, 12)) for c in rng.normal(size=(12, 12))])
    df = spark.createDataFrame([(k * 3, [float(x) for x in v]) for k, v in enumerate(rows)] + [(10**6, None), (10**6 + 1, [0.0] * 12)], "id long, v array<double>")
    return rows, df.repartition(3)


def trust(rows, places, k):
    n = len(rows)
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    before = 1 - unit @ unit.T
    after = ((places[:, None] - places[None]) ** 2).sum(axis=-1)
    for d in (before, after):
        np.fill_diagonal(d, np.inf)
    rank = np.argsort(np.argsort(before, axis=1), axis=1) + 1
    near = np.argsort(after, axis=1)[:, :k]
    return 1 - 2 / (n * k * (2 * n - 3 * k - 1)) * np.maximum(np.take_along_axis(rank, near, 1) - k, 0).sum()


def test_neighbours_are_kept_and_runs_are_equal(spark):
    rows, df = clustered(spark)
    runs = [sorted(map(tuple, embedding.embed(df.repartition(parts), "id", "v", 10, 12).collect())) for parts in (2, 5)]
    assert runs[0] == runs[1] and [r[0] for r in runs[0]] == [k * 3 for k in range(len(rows))]
    places = np.array([r[1:] for r in runs[0]])
    linear = {r.id: r.projection for r in features.project(df.where("id < 1000000"), "v", 2).collect()}
    start = np.array([linear[k * 3] for k in range(len(rows))])
    assert trust(rows, places, 10) > 0.96 and trust(rows, places, 10) > trust(rows, start, 10) + 0.02


def test_graph_equals_loops(spark):
    rows, df = clustered(spark)
    k, unit = 6, rows / np.linalg.norm(rows, axis=1, keepdims=True)
    d = np.round(1 - unit @ unit.T, 9)
    np.fill_diagonal(d, np.inf)
    w = {}
    for i in range(len(rows)):
        near = sorted(range(len(rows)), key=lambda j: (d[i, j], j))[:k]
        low, high, least = 1e-9, 1e3, d[i, near[0]]
        for _ in range(200):
            middle = np.sqrt(low * high)
            low, high = (low, middle) if sum(np.exp(-(d[i, j] - least) / middle) for j in near) > np.log2(k) else (middle, high)
        for j in near:
            w[i, j] = np.exp(-(d[i, j] - least) / high)
    want = {(i, j): w.get((i, j), 0) + w.get((j, i), 0) - w.get((i, j), 0) * w.get((j, i), 0) for i, j in {*w, *((j, i) for i, j in w)}}
    got = {(r.first_id // 3, r.second_id // 3): r.weight for r in embedding.neighbour_graph(df, "id", "v", k).collect()}
    want = {p: x for p, x in want.items() if x > 1e-6}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-6 for p in want)


def test_trustworthiness_by_tables(spark):
    rows, df = clustered(spark)
    places = rows[:, :2]
    n, k = len(rows), 5
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    before = 1 - unit @ unit.T
    after = ((places[:, None] - places[None]) ** 2).sum(axis=-1)
    frames = []
    for d in (before, after):
        np.fill_diagonal(d, np.inf)
        rank = np.argsort(np.argsort(d, axis=1), axis=1) + 1
        frames.append(spark.createDataFrame([(i, j, int(rank[i, j])) for i in range(n) for j in range(n) if i != j], "query_id int, ref_id int, rank int"))
    got = embedding.trustworthiness(*frames, k, n).first()[0]
    assert abs(got - trust(rows, places, k)) < 1e-12


def test_empty(spark):
    empty = spark.createDataFrame([(1, None)], "id long, v array<double>")
    assert embedding.embed(empty.where(F.col("id") > 5), "id", "v").count() == 0


def jobs(spark, name, run):
    """Jobs of Spark that ``run`` starts."""
    spark.sparkContext.setJobGroup(name, name)
    run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_an_epoch_is_one_exchange(spark):
    _, df = clustered(spark)
    few, many = (jobs(spark, f"epochs-{epochs}", lambda: embedding.embed(df, "id", "v", 10, epochs).collect()) for epochs in (2, 8))
    assert many - few <= 6


def by_expressions(edges, start, n, epochs, draws):
    """Places after the epochs, from edges and draws one by one."""
    at = dict(start)
    for epoch in range(epochs):
        force, held = {}, {}
        for i, j, w, drawn in edges:
            held[i] = held.get(i, 0) + round(w * embedding.STEPS)
            for s, to in enumerate([j, *drawn[epoch]]):
                if to == i:
                    continue
                d = np.array(at[i]) - np.array(at[to])
                q = float(d @ d)
                curve = 1 + embedding.CURVE_A * q**embedding.CURVE_B
                pull = -4 * embedding.CURVE_A * embedding.CURVE_B * q ** (embedding.CURVE_B - 1) / curve if q > 0 else 0.0
                f = np.clip((2 * embedding.CURVE_B / ((q + 0.001) * curve) if s else pull) * d, -embedding.MOST, embedding.MOST)
                force[i] = force.get(i, 0) + np.rint(f * w * embedding.STEPS).astype(np.int64)
        step = 1 - epoch / epochs
        at = {i: np.round(p + step * np.clip(3 * force.get(i, np.zeros(2)) / embedding.STEPS / max(1.0, held.get(i, 0) / embedding.STEPS), -embedding.MOST, embedding.MOST), 9) for i, p in at.items()}
    return at


def test_layout_equals_loops(spark, monkeypatch):
    monkeypatch.setattr(embedding, "SMALL", 32)
    rows, df = clustered(spark)
    n, epochs, draws, k = len(rows), 2, 3, 5
    graph = embedding.neighbour_graph(df, "id", "v", k).select((F.col("first_id") / 3).cast("long").alias("i"), (F.col("second_id") / 3).cast("long").alias("j"), "weight")
    drawn = F.array(*(F.array(*(F.pmod(F.xxhash64("i", "j", F.lit(1), F.lit(e), F.lit(s)), F.lit(n)) for s in range(draws))) for e in range(epochs)))
    edges = [tuple(r) for r in graph.withColumn("drawn", drawn).collect()]
    count, axes = features.components(df.where("id < 1000000"), "v", 2)
    linear = dict(enumerate(rows @ axes))
    # Those of Spark, but for signs.
    ml = {r.id // 3: np.array(r.projection) for r in features.project(df.where("id < 1000000"), "v", 2).collect()}
    assert count == n and max(np.abs(np.abs(ml[i]) - np.abs(linear[i])).max() for i in linear) < 1e-9
    widest = max(np.abs(p).max() for p in linear.values())
    want = by_expressions(edges, {i: np.round(p * (10 / widest), 9) for i, p in linear.items()}, n, epochs, draws)
    got = {r.id // 3: (r.x, r.y) for r in embedding.embed(df, "id", "v", k, epochs, draws).collect()}
    assert got.keys() == want.keys() and max(np.abs(want[i] - got[i]).max() for i in want) < 1e-6


def test_hash_is_that_of_expressions(spark):
    rows = spark.createDataFrame([(i * 7919 - 50, j - 3, j * i) for i in range(20) for j in range(9)], "a long, b long, c int")
    got = rows.select("*", F.xxhash64("a", "b", "c").alias("h")).toPandas()
    of = embedding.hashed(got["c"].to_numpy(), embedding.hashed(got["b"].to_numpy(), embedding.hashed(got["a"].to_numpy(), np.uint64(42), True), True), False)
    assert (of.astype(np.int64) == got["h"].to_numpy()).all()
