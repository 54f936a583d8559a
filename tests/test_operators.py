import math
import random

import pytest
from pyspark.sql import functions as F

from plateworks.operators import features, library, metrics, plates, reshape, similarity, splits


def test_library(spark):
    lib = spark.createDataFrame([(1, "Aspirin (salt)", "A01 B02"), (2, "new", "C03 "), (3, None, ""), (4, "other", "A01")], "k int, name string, codes string")
    known = spark.createDataFrame([("aspirin", "A01 "), (None, "")], "name string, codes string")
    codes = F.split("codes", " ")
    assert {r.k for r in library.without_names(lib, known, "name", "name").collect()} == {2, 3, 4}
    assert {r.k for r in library.without_codes(lib, known, codes, codes, "k").collect()} == {2, 3}
    assert {r.k for r in library.drop_overlap(lib, known, "name", codes, codes, "k", [3]).collect()} == {2}
    assert [r.k for r in library.gather(lib, [4, 1, 4], "k").orderBy("ord").collect()] == [4, 1, 4]
    with pytest.raises(Exception, match="no such key"):
        library.gather(lib, [9], "k").collect()


def test_metrics_by_hand(spark):
    rng = random.Random(1)
    rows = [(rng.randint(0, 1), rng.randint(0, 9) / 10) for _ in range(200)]
    df = spark.createDataFrame(rows, "label int, p double")
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg)
    assert abs(metrics.auroc(df, "label", "p").first()[0] - want) < 1e-12
    assert abs(metrics.auroc(df.withColumn("p", F.col("p") * 3 + 1), "label", "p").first()[0] - want) < 1e-12
    curve = metrics.pr_curve(df, "label", "p")
    got = [(r.threshold, r.precision, r.recall) for r in curve.collect()]
    points = []
    for t in sorted({s for _, s in rows}, reverse=True):
        tp, fp = sum(s >= t for s in pos), sum(s >= t for s in neg)
        points.append((t, tp / (tp + fp), tp / len(pos)))
        if tp == len(pos):
            break
    assert sorted(g for g in got if g[0] is not None) == sorted(points) and (None, 1.0, 0.0) in got
    area = sum((b[2] - a[2]) * (a[1] + b[1]) / 2 for a, b in zip([(None, 1.0, 0.0), *points], points))
    assert abs(metrics.pr_auc(curve).first()[0] - area) < 1e-12
    best = max(points, key=lambda x: (2 * x[1] * x[2] / (x[1] + x[2]), -x[0]))
    assert metrics.best_threshold(curve).first().threshold == best[0]
    moved = {r.recall: r.threshold for r in metrics.pr_curve(df, "label", "p", legacy_alignment=True).collect()}
    assert moved[points[-1][2]] == float("inf") and moved[points[0][2]] == points[1][0]
    none = metrics.confusion(df, "label", F.lit(False)).first()
    assert none.precision == 0 and none.f1 == 0
    assert metrics.auroc(df.where("label = 1"), "label", "p").first()[0] is None


def test_splits(spark):
    df = spark.createDataFrame([(k, f"g{k % 7 if k < 70 else k}") for k in range(100)], "k int, g string")
    out = splits.group_split(df, "g", "k").collect()
    assert len(out) == 100 and len({(r.g, r.split) for r in out}) == len({r.g for r in out})
    sizes = {s: sum(r.split == s for r in out) for s in ("train", "valid", "test")}
    assert sizes["train"] <= 80 and sizes["valid"] <= 10
    exact = splits.exact_split(df, splits.seeded("k", 3), 0.1, 0.2).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in exact} == {"valid": 10, "test": 20, "train": 70}
    assert splits.group_split(df.limit(0), "g", "k").count() == 0


def test_features(spark):
    df = spark.createDataFrame([([1.0, 2.0, 0.0],), ([2.0, 4.0, 1.0],), ([3.0, 6.0, 0.0],)], "v array<double>")
    assert [r.variance for r in features.variances(df, "v").orderBy("pos").collect()][:2] == [1.0, 4.0]
    assert [r.pos for r in features.correlated(df, "v", 3, 0.9).collect()] == [1]
    got = {(r.i, r.j): r.hamming for r in features.hamming_features(df, "v").collect()}
    assert got[(0, 1)] == 0 and abs(got[(0, 2)] - 2 / 3) < 1e-12
    assert features.keep_positions(df, "v", [2, 0]).first().v == [0.0, 1.0]


def test_similarity_properties(spark):
    rng = random.Random(2)
    e = spark.createDataFrame([(k, [rng.gauss(0, 1) for _ in range(64)]) for k in range(30)], "id int, v array<float>")
    d = similarity.distances(e, e, "id", "v").collect()
    by = {(r.query_id, r.ref_id): r for r in d}
    for (a, b), r in by.items():
        assert abs(r.cosine_dist - by[b, a].cosine_dist) < 1e-9 and -1e-9 <= r.jaccard_dist <= 1 and (a != b or abs(r.cosine_dist) < 1e-9 and r.jaccard_dist == 0)
    ranks = similarity.rank_first(similarity.distances(e, e, "id", "v"), F.col("cosine_dist"), ["ref_id"], "rank").collect()
    assert sorted(r["rank"] for r in ranks if r.query_id == 3) == list(range(1, 31))


def test_plates(spark):
    t = [k / 2 for k in range(30)]
    od = [1.2 / (1 + math.exp(-0.9 * (x - 6))) for x in t]
    rows = [("c", x, y) for x, y in zip(t, od)] + [("flat", x, 0.01) for x in t]
    got = {r.c: r for r in plates.fit_curves(spark.createDataFrame(rows, "c string, x double, od double"), "c", "x", "od").collect()}
    r = got["c"]
    assert r.fit_ok and abs(r.top - 1.2) < 1e-3 and abs(r.rate - 0.9) < 1e-3 and abs(r.middle - 6) < 1e-3 and abs(r.generation_time - math.log(2) / 0.9) < 1e-3
    assert not got["flat"].fit_ok and got["flat"].generation_time == 0
    wells = [("A1", "Water", 0.0), ("H1", "Water", 0.0), ("B1", "DMSO", 0.002), ("B2", "DMSO", 0.01), ("A5", "drug", 0.0), ("C5", "drug", 0.01)]
    out = {r.well: r for r in plates.control_wells(spark.createDataFrame(wells, "well string, compound string, dmso_percentage double")).collect()}
    assert out["A5"].water_row == "A1" and out["A5"].dmso_well == "B1" and out["C5"].dmso_well == "B2" and out["C5"].water_row is None and out["C5"].water_h == "H1"
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0)], "k string, od double")
    assert plates.panel(df, ["k"], "od", "both").count() == 5 and plates.panel(df, ["k"], "od").count() == 2


def test_shapes(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, a string"), spark.createDataFrame([(2, 5)], "k int, b int")
    assert reshape.stack([a, b]).columns == ["k", "a", "b"]
    r = reshape.venn(a, b, "k").first()
    assert tuple(r) == (1, 0, 1)
    assert reshape.clip_to_quartiles(spark.createDataFrame([(float(k),) for k in range(5)], "v double"), "v").agg(F.min("clipped"), F.max("clipped")).first() == (1.0, 3.0)


def test_projection_and_dose_growth(spark):
    rng = random.Random(5)
    rows = [(k, [float(3 * rng.gauss(0, 1)), rng.gauss(0, 1) * 0.1, 0.0]) for k in range(40)]
    got = features.project(spark.createDataFrame(rows, "k int, v array<double>"), "v", 1).collect()
    assert all(abs(abs(r.projection[0]) - abs(r.v[0])) < 0.3 for r in got)
    data = [(c, d, f"{c}{d}{n}", h, float(h + n)) for c in ("DMSO", "drug", "Water") for d in (1.0, 2.0) for n in range(3) for h in (0.0, 5.0, 9.0)]
    df = spark.createDataFrame(data, "compound string, concentration double, curve string, hours double, corrected double")
    out = plates.dose_growth(df, 5.5, ["curve"], ["Water"]).orderBy("level", "concentration").collect()
    assert [(r.compound, r.concentration, r.n, r.mean_od, r.median_od) for r in out] == [(c, d, 3, 6.0, 6.0) for c in ("DMSO", "drug") for d in (1.0, 2.0)]
    fits = spark.createDataFrame([("A1", 0.5)], "well string, rate double")
    wells = spark.createDataFrame([("A1", "drug", 2.0), ("A2", "drug", 4.0)], "well string, compound string, concentration double")
    water = spark.createDataFrame([("H1", "Water", 0.0, 0.7)], "well string, compound string, concentration double, rate double")
    assert plates.compare_parameters(fits, wells, water).count() == 3


def test_split_follows_a_plain_loop_of_the_rule(spark):
    import random

    rng = random.Random(3)
    for case in range(4):
        groups = [rng.choice([1, 1, 1, 2, 2, 3, 5, 8, 13]) for _ in range(40)] if case else [7, 2, 1]
        rows, key = [], 0
        for g, n in enumerate(groups):
            rows += [(f"g{g}", key + k) for k in range(n)]
            key += n
        firsts = {f"g{g}": min(k for x, k in rows if x == f"g{g}") for g in range(len(groups))}
        sizes = {f"g{g}": n for g, n in enumerate(groups)}
        train, valid, want = 0, 0, {}
        for name in sorted(sizes, key=lambda x: (sizes[x], firsts[x]), reverse=True):
            if train + sizes[name] <= 0.8 * len(rows):
                train, want[name] = train + sizes[name], "train"
            elif train + valid + sizes[name] <= 0.9 * len(rows):
                valid, want[name] = valid + sizes[name], "valid"
            else:
                want[name] = "test"
        got = splits.group_split(spark.createDataFrame(rows, "g string, k long"), "g", "k").collect()
        assert {r.g: r.split for r in got} == want and len(got) == len(rows)
    assert {want for want in splits.group_split(spark.createDataFrame([("a", k) for k in range(7)] + [("b", 8), ("b", 9), ("c", 10)], "g string, k long"), "g", "k").select("g", "split").distinct().collect()} == {("a", "train"), ("b", "valid"), ("c", "train")}


def test_bits_that_no_row_has(spark):
    df = spark.createDataFrame([([1.0, 0.0, 1.0],), ([1.0, 0.0, 0.0],)], "v array<double>")
    assert {(r.i, r.j): r.hamming for r in features.hamming_features(df, "v").collect()} == {(0, 1): 1.0, (0, 2): 0.5, (1, 2): 0.5}


def test_many_queries_go_in_blocks(spark):
    e = spark.createDataFrame([(k, [float(k % 5), 1.0, float(k % 3)]) for k in range(60)], "id long, v array<double>")
    rows = lambda d: sorted((r.query_id, r.ref_id, r.jaccard_dist) for r in d.collect())
    whole = rows(similarity.distances(e, e, "id", "v"))
    assert len(whole) == 3600 and rows(similarity.distances(e, e, "id", "v", limit=7)) == whole


def test_small_shapes(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, None)], "k string, x double, y double")
    assert sorted(map(tuple, reshape.transposed(df, "k", ["x", "y"], ["a", "b"]).collect())) == [("x", 1.0, 3.0), ("y", 2.0, None)]
    best = spark.createDataFrame([("g", 0.5, 2), ("g", 0.5, 1), ("g", None, 0), ("h", None, 3)], "g string, f1 double, n int")
    assert sorted(map(tuple, reshape.best_of_group(best, "g", "f1", "n").collect()), key=str) == [("g", 0.5, 1), ("h", None, 3)]
    q = spark.createDataFrame([("7",), ("7.0",), ("x",), (None,)], "cid string")
    known = spark.createDataFrame([(7, "seven")], "cid long, name string").withColumnRenamed("cid", "number")
    got = library.lookup_by_number(q.withColumnRenamed("cid", "number"), known, "number", "name").collect()
    assert [r["name"] for r in got].count("seven") == 2 and [r["name"] for r in got].count("not_found") == 2
    out = library.enrich(spark.createDataFrame([("c", 12), ("d", 3)], "chem_id string, nk_total int"), spark.createDataFrame([("c", "X")], "chem_id string, ProductName string"), "chem_id")
    assert sorted((r.chem_id, r.ProductName, r.broad_spectrum) for r in out.collect()) == [("c", "X", 1), ("d", None, 0)]


def test_more_functions(spark):
    from plateworks import functions

    functions.register(spark)
    df = spark.createDataFrame([("staph aureus", 0.125, 12, "Name\t (x)")], "s string, x double, n int, name string")
    r = df.select(functions.title_case(F.col("s")).alias("t"), functions.half_even(F.col("x")).alias("h"), functions.count_label(F.col("n")).alias("c"),
                  functions.from_params(functions.to_params(F.struct("n"))).alias("p"), functions.clean_name(F.col("name")).alias("a"), F.expr("clean_name(name)").alias("b")).first()
    assert (r.t, r.h, r.c, r.p, r.a, r.b) == ("Staph Aureus", 0.12, "n = 12", {"n": "12"}, "name", "name")


def test_models_can_be_loaded_again(spark, tmp_path):
    from plateworks.operators import training

    rows = [(f"c{k}", f"s{k % 2}", k % 2, [float(k % 5), float(k)], "train" if k < 30 else "valid" if k < 35 else "test") for k in range(40)]
    screen = spark.createDataFrame([(a, b, c) for a, b, c, _, _ in rows], "chem_id string, strain_name string, label int")
    vectors = spark.createDataFrame([(a, v) for a, _, _, v, _ in rows], "chem_id string, vector array<double>")
    strains = spark.createDataFrame([("s0", 0), ("s1", 1)], "strain_name string, strain_ord int")
    parts = spark.createDataFrame([(a, s) for a, _, _, _, s in rows], "chem_id string, split string")
    model = training.fit(training.training_frame(screen, vectors, strains, parts, 2), {"maxIter": 2, "maxDepth": 2})
    path = training.save(model, str(tmp_path), "model", "x")
    want = sorted(map(tuple, training.predict(model, vectors, strains, 2).collect()))
    assert sorted(map(tuple, training.predict(training.load(path), vectors, strains, 2).collect())) == want and len(want) == 80


def test_slope_of_readings_at_one_hour_is_open(spark):
    rows = [("one", 2.0, 3.5), ("one", 0.0, 9.0), ("same", 1.0, 2.0), ("same", 3.0, 2.0), ("none", 0.0, 1.0), ("flat", 1.0, 0.0), ("flat", 1.0, 1.0), ("up", 1.0, 0.0), ("up", 2.0, 1.0)]
    got = {r.curve: r.generation_time for r in plates.slopes(spark.createDataFrame(rows, "curve string, corrected double, hours double"), ["curve"]).collect()}
    assert str(got["one"]) == str(got["same"]) == "nan" and got["none"] == got["flat"] == 0 and abs(got["up"] - 1) < 1e-12


def test_log_of_distance_zero(spark):
    df = spark.createDataFrame([(1, 2, 0.0, 0.5), (1, 3, 0.25, 0.0)], "query_id long, ref_id long, a_dist double, b_dist double")
    for found in (similarity.compare_metrics(df, ["a", "b"]), similarity.compare_top(df, ["a", "b"], 2)):
        assert {(r.ref_id, r.a_log2, r.b_log2) for r in found.collect()} == {(2, float("-inf"), -1.0), (3, -2.0, float("-inf"))}
