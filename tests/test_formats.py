"""Data sources: headers a file, pruning, pushed filters; writers whose repeated tasks leave no double rows."""

import gzip
import json
import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from plateworks.sources import formats, read_plates

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def folder(spark, tmp_path):
    formats.register(spark)
    with gzip.open(tmp_path / "E_coli_1_OD.tsv.gz", "wt") as out:
        out.write("Time\tA1\tH12\tTemp\n\n01/02/2024 10:00:00\t0.1\t0.2\t37\n01/02/2024 11:00:00\tx\t0.4\t37\n")
    with gzip.open(tmp_path / "SA_2_OD.tsv.gz", "wt") as out:
        out.write("H12\tTime\tA1\n0.5\t01/02/2024 10:00:00\t0.6\n" + "".join(f"0.{k}\t01/02/2024 12:00:00\t0.1\n" for k in range(2500)))
    return tmp_path


def test_plates_equal_the_reader(spark, folder):
    path = str(folder / "*_OD.tsv.gz")
    got, want = spark.read.format("plates").load(path), read_plates(spark, path).where("well is not null")
    columns = ["file", "organism", "replicate", "well", F.unix_micros("time").alias("t"), "od"]
    assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))
    assert got.rdd.getNumPartitions() == 2


def test_filters_are_pushed_and_columns_pruned(spark, folder):
    df = spark.read.format("plates").schema("well string, od double, organism string").load(str(folder)).where("well = 'H12' and organism in ('SA', 'X') and od > 0.45")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan or "BatchScan" in plan
    assert df.rdd.getNumPartitions() == 1  # the other file is not opened
    assert {r.organism for r in df.collect()} == {"SA"} and df.count() == 1 + sum(float(f"0.{k}") > 0.45 for k in range(2500))
    reader = formats.PlateReader(df.schema, {"path": str(folder)})
    rest = list(reader.pushFilters([formats.EqualTo(("well",), "H12"), formats.In(("organism",), ("SA",))]))
    parts = reader.partitions()
    assert rest == [] and len(parts) == 1 and parts[0].wells == ("H12",)
    batch = next(reader.read(parts[0]))
    assert batch.schema.names == ["well", "od", "organism"] and set(batch.column("well").to_pylist()) == {"H12"}


def test_file_without_header_is_an_error(spark, folder):
    (folder / "bad_1_OD.tsv").write_text("01/02/2024 10:00:00\t0.1\n")
    with pytest.raises(Exception, match="no header"):
        spark.read.format("plates").load(str(folder)).count()
    (folder / "bad_1_OD.tsv").write_text("")
    with pytest.raises(Exception, match="no header"):
        spark.read.format("plates").load(str(folder)).count()


def test_manifest_append_and_overwrite(spark, tmp_path):
    formats.register(spark)
    path = str(tmp_path / "out")
    df = spark.range(1000).select("id", (F.col("id") % 7).cast("string").alias("s"))
    df.write.format("manifest").mode("append").save(path)
    df.where("id < 10").write.format("manifest").mode("append").save(path)
    back = spark.read.format("manifest").load(path)
    assert back.count() == 1010 and back.select("id").distinct().count() == 1000
    assert spark.read.format("manifest").schema("s string").load(path).columns == ["s"]
    df.where("id < 5").write.format("manifest").mode("overwrite").save(path)
    assert sorted(r.id for r in spark.read.format("manifest").load(path).collect()) == [0, 1, 2, 3, 4]
    listed = {s["file"] for s in json.load(open(f"{path}/manifest.json"))}
    assert listed == {f for f in os.listdir(path) if f.endswith(".parquet")}


def test_repeated_task_leaves_no_double_rows(tmp_path):
    """A task of the write fails once, after it has written rows; the second attempt's file alone is listed."""
    script = f"""
    import sys
    sys.path.insert(0, {ROOT!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession
    from plateworks.sources import formats
    spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
    formats.register(spark)

    def once(batches):
        context = TaskContext.get()
        for k, batch in enumerate(batches):
            yield batch
        if context.partitionId() == 1 and context.attemptNumber() == 0:
            raise RuntimeError("the task ends after its rows")

    df = spark.range(0, 50_000, 1, 4).mapInArrow(once, "id long")
    df.write.format("manifest").mode("append").save({str(tmp_path / "out")!r})
    back = spark.read.format("manifest").load({str(tmp_path / "out")!r})
    print("ROWS", back.count(), back.distinct().count())
    """
    ran = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, text=True, timeout=240)
    assert "ROWS 50000 50000" in ran.stdout, ran.stderr[-2000:]
    files = [f for f in os.listdir(tmp_path / "out") if f.endswith(".parquet")]
    listed = json.load(open(tmp_path / "out" / "manifest.json"))
    assert len(files) >= len(listed) and sum(s["rows"] for s in listed) == 50_000
