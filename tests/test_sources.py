import gzip

import numpy as np
import pytest
from pyspark.sql import functions as F

from plateworks import sources
from plateworks.__main__ import main
from plateworks.chem import network
from plateworks.streaming import potential_stream, score_stream, windowed_counts


def test_molecules(spark, tmp_path):
    path = tmp_path / "m.tsv"
    path.write_text("chem_name\tsmiles\nA\tCCO\nB\t\n\tCC\nA\tC1\n")
    df = sources.read_molecules(spark, str(path), chem_id="chem_name")
    assert sorted((r.chem_id, r.smiles) for r in df.collect()) == [("A", "C1"), ("A", "CCO")]
    assert sources.read_molecules(spark, df, valid=lambda c: c.rlike("O")).count() == 1
    kept = sources.read_molecules(spark, str(path), chem_id="chem_name", cast_id_first=True)
    assert sorted((r.chem_id, r.smiles) for r in kept.collect()) == [("A", "C1"), ("A", "CCO"), ("nan", "CC")]


def test_wide_files(spark, tmp_path):
    path = tmp_path / "r.tsv.gz"
    with gzip.open(path, "wt") as out:
        out.write("\t0\t1\nA\t0.5\t1\nB\t2\t\n")
    got = {r.chem_id: r.vector for r in sources.read_representation(spark, str(path)).collect()}
    assert got == {"A": [0.5, 1.0], "B": [2.0, None]}
    (tmp_path / "s.tsv").write_text("id\tX (NT1)\tY. b\nA\t0.01\t\n")
    got = {(r.id, r.strain_name, r.value) for r in sources.read_matrix(spark, str(tmp_path / "s.tsv"), "id").collect()}
    assert got == {("A", "X (NT1)", 0.01)} or got == {("A", "X (NT1)", 0.01), ("A", "Y. b", None)}


def test_plates(spark, tmp_path):
    for name in ("SA_1_OD.tsv", "E_coli_2_OD.tsv"):
        (tmp_path / name).write_text("Time\tA1\tH12\n01/02/2024 10:00:00\t0.1\t0.2\n01/02/2024 11:00:00\t0.3\t0.4\n")
    rows = sources.read_plates(spark, str(tmp_path / "*_OD.tsv")).collect()
    assert len(rows) == 8 and {r.well for r in rows} == {"A1", "H12"} and max(r.od for r in rows) == 0.4


def test_sheets(spark, tmp_path):
    df = spark.createDataFrame([(1, "a<b", 0.5), (2, None, 1.5)], "k int, t string, v double")
    path = str(tmp_path / "w.xlsx")
    sources.write_sheets({"one": df, "two": df.limit(1)}, path)
    assert [tuple(r) for r in sources.read_sheet(spark, path, "one").collect()] == [("1", "a<b", "0.5"), ("2", None, "1.5")]
    assert sources.read_sheet(spark, path, 1, skip=[0]).columns == ["1", "a<b", "0.5"]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, 'q"x'), (2, None)], "k int, t string")
    path = str(tmp_path / "o.tsv")
    sources.write_tsv(df.orderBy("k"), path)
    assert open(path).read().splitlines()[:2] == ["k\tt", '1\tq"x']
    sources.write_tsv(df, path + ".gz")
    assert gzip.open(path + ".gz", "rt").readline() == "k\tt\n"
    for _ in range(2):
        sources.append_tsv(df, str(tmp_path / "a.tsv"))
    assert len(open(tmp_path / "a.tsv").readlines()) == 5
    sources.write_shards(spark.range(100), str(tmp_path / "sh"), "id", 4)
    assert spark.read.parquet(str(tmp_path / "sh")).count() == 100


def test_command_line(spark, tmp_path):
    (tmp_path / "p.tsv").write_text("pred_id\tantimicrobial_predictive_probability\nA:S (NT1)\t0.5\nA:T (NT2)\t0.25\n")
    (tmp_path / "s.tsv").write_text("strain_name\tgram_stain\nS (NT1)\tnegative\nT (NT2)\tpositive\n")
    main(["predict", str(tmp_path / "p.tsv"), str(tmp_path / "o.tsv"), "-a", "-s", str(tmp_path / "s.tsv"), "-k", "2"])
    head, row = open(tmp_path / "o.tsv").read().splitlines()
    assert head.split("\t")[0] == "chem_id" and row.split("\t")[4:] == ["2", "1", "1", "1"]
    (tmp_path / "m.tsv").write_text("chem_id\tsmiles\nA\tCCO\n")
    main(["represent", str(tmp_path / "m.tsv"), str(tmp_path / "v.tsv"), "-m", "counts"])
    assert len(open(tmp_path / "v.tsv").readlines()[1].split("\t")) == 8
    with pytest.raises(SystemExit):
        main(["represent", str(tmp_path / "m.tsv"), str(tmp_path / "v.tsv")])
    np.savez(tmp_path / "w.npz", **network.random_weights(5, 8))
    main(["represent", str(tmp_path / "m.tsv"), str(tmp_path / "v.tsv"), "-w", str(tmp_path / "w.npz")])
    assert len(open(tmp_path / "v.tsv").readlines()[1].split("\t")) == 41


def test_streams(spark, tmp_path):
    source = tmp_path / "in"
    spark.createDataFrame([("a", 0.9), ("b", 0.01)], "chem_id string, x double").write.parquet(str(source))
    strains = spark.createDataFrame([("A (NT1)", "negative"), ("B (NT2)", "positive")], "strain_name string, gram_stain string")
    stream = spark.readStream.schema("chem_id string, x double").parquet(str(source))
    scored = score_stream(stream, strains, lambda d: d["x"])
    q = potential_stream(scored).writeStream.format("memory").queryName("pot").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(r.chem_id, r.ginhib_total) for r in spark.table("pot").collect()} == {("a", 2), ("b", 0)}
    times = spark.createDataFrame([("2024-01-01 00:10:00", "x"), ("2024-01-01 00:50:00", "x"), ("2024-01-01 01:10:00", "x")], "t string, k string").withColumn("t", F.to_timestamp("t"))
    assert sorted(r.n for r in windowed_counts(times, "t", ["k"]).collect()) == [1, 2]


def test_files_with_another_order_of_columns(spark, tmp_path):
    (tmp_path / "a_1_OD.tsv").write_text("Time\tA1\tA2\n01/02/2023 10:00:00\t0.1\t0.2\n")
    (tmp_path / "b_1_OD.tsv").write_text("Time\tA2\tA1\n01/02/2023 10:00:00\t0.3\t0.4\n")
    rows = sources.read_plates(spark, str(tmp_path / "*_OD.tsv")).collect()
    assert {(r.organism, r.well): r.od for r in rows} == {("a_1", "A1"): 0.1, ("a_1", "A2"): 0.2, ("b_1", "A1"): 0.4, ("b_1", "A2"): 0.3}
    (tmp_path / "m1.tsv").write_text("id\ts1\ts2\nx\t1\t2\n")
    (tmp_path / "m2.tsv").write_text("id\ts2\ts1\ny\t1\t2\n")
    with pytest.raises(Exception):
        sources.read_matrix(spark, [str(tmp_path / "m1.tsv"), str(tmp_path / "m2.tsv")], "id").collect()
    (tmp_path / "r1.tsv").write_text("\t0\t1\nx\t1\t2\n")
    (tmp_path / "r2.tsv").write_text("\t1\t0\ny\t1\t2\n")
    with pytest.raises(ValueError):
        sources.read_representation(spark, [str(tmp_path / "r1.tsv"), str(tmp_path / "r2.tsv")])


def test_csv_and_markdown(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 1), (None, 2)], "s string, n int").coalesce(1)
    sources.write_csv(df, str(tmp_path / "c"))
    assert sorted(map(tuple, spark.read.option("header", True).csv(str(tmp_path / "c")).collect()), key=str) == [("a,b", "1"), (None, "2")]
    assert sources.markdown(df) == "| s | n |\n| --- | --- |\n| a,b | 1 |\n|  | 2 |"


def test_rows_without_id_and_files_without_header(spark, tmp_path):
    (tmp_path / "r1.tsv").write_text("\t0\t1\nx\t1\t2\n\t3\t4\n")
    (tmp_path / "r2.tsv").write_text("\t0\t1\n\t5\t6\n")
    rows = sources.read_representation(spark, [str(tmp_path / "r1.tsv"), str(tmp_path / "r2.tsv")]).collect()
    assert sorted(((r.chem_id, r.vector) for r in rows), key=str) == [("x", [1.0, 2.0]), (None, [3.0, 4.0]), (None, [5.0, 6.0])]
    (tmp_path / "a_1_OD.tsv").write_text("Time\tA1\n01/02/2023 10:00:00\t0.1\n")
    (tmp_path / "b_1_OD.tsv").write_text("01/02/2023 10:00:00\t0.3\n")
    with pytest.raises(Exception, match="no header"):
        sources.read_plates(spark, str(tmp_path / "*_OD.tsv")).collect()
