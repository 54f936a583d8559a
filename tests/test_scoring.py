import math
import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from published import PAIRS, POTENTIAL  # noqa: E402

from plateworks.functions import log_mean, none_if_nan, register  # noqa: E402
from plateworks.operators import scoring  # noqa: E402


def test_published_potentials(spark):
    rows = [(c, s, g, p) for s, g, a, b in PAIRS for c, p in (("Halicin", a), ("Tannic acid", b))]
    got = scoring.potential(spark.createDataFrame(rows, "chem_id string, strain_name string, gram_stain string, p double")).collect()
    for r in got:
        want = POTENTIAL[r.chem_id]
        assert all(abs(a - b) < 1e-6 for a, b in zip(r[1:4], want[:3])) and tuple(r[4:]) == want[3:], r


def test_nulls_zero_and_missing_stains(spark):
    rows = [("a", None, 0.5), ("a", "negative", float("nan")), ("z", "positive", 0.0), ("z", "positive", 0.5), ("a", "negative", 0.25)]
    df = spark.createDataFrame(rows, "chem_id string, gram_stain string, p double").withColumn("p", none_if_nan(F.col("p")))
    got = {r.chem_id: r for r in scoring.potential(df, broad=2).collect()}
    assert got["a"].ginhib_total == 2 and got["a"].ginhib_gnegative == 1 and got["a"].ginhib_gpositive is None and got["a"].apscore_gpositive is None
    assert abs(got["a"].apscore_total - (math.log(0.5) + math.log(0.25)) / 2) < 1e-12
    assert got["z"].apscore_total == float("-inf") and got["z"].broad_spectrum == 0 and got["a"].broad_spectrum == 1
    assert df.limit(0).agg(log_mean(F.col("p"))).first()[0] is None


def test_pairs_and_ids(spark):
    mol = spark.createDataFrame([("x:y", 1), ("b", 2)], "chem_id string, n int")
    strains = spark.createDataFrame([("Some sp. (ET) (NT5033)",), ("Other (NT1)",)], "strain_name string")
    pairs = scoring.pair_all(mol, strains)
    assert pairs.count() == 4
    with pytest.raises(ValueError):
        scoring.pair_all(mol, strains, limit=1)
    ids = pairs.select(scoring.pair_id(F.col("chem_id"), F.col("strain_name")).alias("pred_id"))
    got = {(r.chem_id, r.strain_name, r.nt_number) for r in scoring.split_pair_id(ids).collect()}
    assert got == {(c, s, n) for c in ("x:y", "b") for s, n in (("Some sp. (ET) (NT5033)", "NT5033"), ("Other (NT1)", "NT1"))}
    table = spark.createDataFrame([("b", "Other (NT1)", 0.3)], "chem_id string, strain_name string, s double")
    assert scoring.table_scorer(table, ["chem_id", "strain_name"], "s")(pairs).where("p is not null").count() == 1


def test_sql_functions(spark):
    register(spark)
    r = spark.sql("select strain_number('A (ET) (NT12)') a, clean_name('Ab (c) [d]') b, bit_similarity(3L, 1L) c, bit_similarity(0L, 0L) d, round(cosine_distance(array(1D, 0D), array(0D, 1D)), 6) e, generation_time(0D) f, strain_number('x') g").first()
    assert tuple(r) == ("NT12", "ab", 0.5, 1.0, 1.0, 0.0, None)
