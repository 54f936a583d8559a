"""Exact quantiles equal those of sorted values; the rows gathered are few."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plateworks.operators import quantiles as Q

SHARES = {"q25": 0.25, "q50": 0.5, "q99": 0.99}


@pytest.mark.parametrize("small,accuracy", [(2000, 500), (3, 10), (0, 4)])
def test_groups(spark, small, accuracy):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1.0, 1.0, -2.5, rng.gauss(0, 1), 10 ** rng.uniform(-30, 30)])) for _ in range(700)]
    rows += [("one", 4.0), ("none", None), ("nan", float("nan")), ("nan", 3.0), *(("same", 7.0) for _ in range(90))]
    got = {r.g: r for r in Q.quantiles(spark.createDataFrame(rows, "g string, x double"), "x", SHARES, ["g"], small, accuracy).collect()}
    assert got.keys() == {g for g, _ in rows}
    for g, row in got.items():
        values = sorted(x for h, x in rows if h == g and x is not None and x == x)
        assert row.n == len(values)
        for name, share in SHARES.items():
            if not values:
                assert row[name] is None
            else:
                assert np.isclose(row[name], np.quantile(values, share), rtol=1e-12, atol=1e-12)


def test_no_groups_and_empty_table(spark):
    df = spark.createDataFrame([(float(k),) for k in range(101)], "x double")
    assert Q.quantiles(df, "x", {"a": 0.1, "b": 1.0, "c": 0.0}, small=5, accuracy=8).collect() == [(101, 10.0, 100.0, 0.0)]
    assert Q.quantiles(df.where("x < 0"), "x", {"a": 0.5}).collect() == [(0, None)]


def test_million_distinct_values_gather_few_rows(spark, monkeypatch):
    n, states, write = 1_000_000, [], Q.stored

    def kept(df, name):
        out = write(df, name)
        states.extend([out] * (name == "quantile-state"))
        return out

    monkeypatch.setattr(Q, "stored", kept)
    df = spark.range(n).select(((F.col("id") * 7919 + 13) % n).cast("double").alias("x"))
    out = Q.quantiles(df, "x", {"q": 0.3}).collect()[0]
    assert abs(out.q - 0.3 * (n - 1)) < 1e-6
    last = states[-1].collect()[0]
    for side in ("lower", "upper"):
        gathered = df.where((F.col("x") > (last[f"_q_{side}_low"] or -1)) & (F.col("x") < (last[f"_q_{side}_high"] or n))).count()
        assert last[f"_q_{side}_is"] is not None or gathered == last[f"_q_{side}_m"] <= Q.SMALL
    assert len(states) <= 4
