"""Running sums over ranges equal plain loops, whatever the ranges."""

import random

import pytest
from pyspark.sql import functions as F

from plateworks.operators import metrics, ordered


@pytest.mark.parametrize("parts", [1, 5, 20])
def test_sums_and_ranks(spark, parts):
    rng = random.Random(parts)
    rows = [(k, rng.randrange(50), None if k % 7 == 0 else rng.randrange(-9, 9), rng.random()) for k in range(300)]
    df = spark.createDataFrame(rows, "id long, by int, n int, x double")
    got = ordered.ordered_sums(df, [F.desc("by"), F.asc("id")], {"before": F.col("n"), "share": F.col("x")}, parts)
    n, x, want = 0, 0.0, {}
    for row in sorted(rows, key=lambda r: (-r[1], r[0])):
        want[row[0]] = (n, x)
        n, x = n + (row[2] or 0), x + row[3]
    found = {r.id: (r.before, r.share) for r in got.collect()}
    assert found.keys() == want.keys()
    assert all(found[k][0] == want[k][0] and abs(found[k][1] - want[k][1]) < 1e-9 for k in want)
    ranks = ordered.ordered_ranks(df, [F.desc("by"), F.asc("id")], parts=parts).collect()
    assert [r.id for r in sorted(ranks, key=lambda r: r["rank"])] == list(dict.fromkeys(r[0] for r in sorted(rows, key=lambda r: (-r[1], r[0]))))


def test_next_row_and_empty_table(spark):
    df = spark.createDataFrame([(k,) for k in (5, 3, 9, 1)], "k long")
    got = {r.k: r.then for r in ordered.with_next(df, [F.asc("k")], {"then": "k"}, 3).collect()}
    assert got == {1: 3, 3: 5, 5: 9, 9: None}
    assert ordered.ordered_ranks(df.where("k > 100"), [F.asc("k")]).count() == 0


def test_curves_with_distinct_scores_in_twenty_ranges(spark):
    n = 5000
    df = spark.range(n).select((F.xxhash64("id") % 2 == 0).cast("int").alias("label"), ((F.col("id") * 7919) % n / n).alias("p"))
    rows = sorted(((r.p, r.label) for r in df.collect()), reverse=True)
    pos = sum(y for _, y in rows)
    below, won = 0, 0
    for _, y in reversed(rows):
        below, won = below + (1 - y), won + y * below
    area = metrics.auroc(df, "label", "p", parts=20)
    assert abs(area.first()[0] - won / (pos * (n - pos))) < 1e-12
    tp, points = 0, []
    for k, (p, y) in enumerate(rows):
        if tp < pos:
            tp += y
            points.append((p, tp / (k + 1), tp / pos))
    curve = metrics.pr_curve(df, "label", "p", parts=20)
    got = sorted(curve.where("threshold is not null").collect(), reverse=True)
    assert len(got) == len(points)
    assert all(abs(a - b) < 1e-12 for row, want in zip(got, points) for a, b in zip(row, want))
    by_recall = sorted([(r, -p, q) for p, q, r in points], reverse=True) + [(0.0, 0, 1.0)]
    trapezoids = sum((a[0] - b[0]) * (a[2] + b[2]) / 2 for a, b in zip(by_recall, by_recall[1:]))
    under = metrics.pr_auc(curve, parts=20)
    assert abs(under.first()[0] - trapezoids) < 1e-9
    for plan in (area, curve, under):
        assert "Window" not in plan._jdf.queryExecution().toString()
