"""A stream that is stopped and started again ends with the batch result; repeated batches change nothing."""

import math
import random
import time


from plateworks.operators import scoring
from plateworks.streaming.potentials import latest, latest_by_batch, running_potentials

SCHEMA = "chem_id string, gram_stain string, p double"


def rows(seed, n):
    rng = random.Random(seed)
    return [(f"c{rng.randrange(12)}" if rng.random() > 0.05 else None, rng.choice(["negative", "positive", None]), rng.choice([None, 0.0 if rng.random() < 0.02 else rng.random(), rng.random() / 20])) for _ in range(n)]


def start(spark, source, out, state, **options):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    return running_potentials(stream, **options).writeStream.outputMode("update").option("checkpointLocation", state)


def test_restart_equals_batch(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for seed in range(2):
        spark.createDataFrame(rows(seed, 60), SCHEMA).coalesce(1).write.mode("append").parquet(source)
    run = lambda: start(spark, source, out, state).foreachBatch(latest_by_batch(out)).trigger(availableNow=True).start().awaitTermination(120)
    assert run()
    first = {r.chem_id: r.n_rows for r in latest(spark.read.parquet(out)).collect()}
    spark.createDataFrame(rows(7, 80), SCHEMA).coalesce(1).write.mode("append").parquet(source)
    assert run()  # from the checkpoint
    every = spark.read.parquet(source)
    got = {r.chem_id: r for r in latest(spark.read.parquet(out)).collect()}
    want = {r.chem_id: r for r in scoring.potential(every).collect()}
    counts = {r.chem_id: r["count"] for r in every.groupBy("chem_id").count().collect()}
    assert got.keys() == want.keys() and sum(first.values()) == 120
    for key, row in want.items():
        assert got[key].n_rows == counts[key] and not got[key].expired
        for name in row.asDict():
            a, b = got[key][name], row[name]
            assert a == b or math.isclose(a, b, rel_tol=1e-9), (key, name, a, b)
    # A batch that is written again replaces itself.
    again = spark.read.parquet(out).where("batch = 2").drop("batch")
    kept = spark.createDataFrame(again.collect(), again.schema)
    latest_by_batch(out)(kept, 2)
    assert {r.chem_id: r.n_rows for r in latest(spark.read.parquet(out)).collect()} == {k: r.n_rows for k, r in got.items()}


def test_idle_compounds_expire(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    spark.createDataFrame([("a", "negative", 0.5)], SCHEMA).coalesce(1).write.parquet(source)
    query = start(spark, source, out, state, idle_ms=1500).foreachBatch(latest_by_batch(out)).trigger(processingTime="500 milliseconds").start()
    try:
        for _ in range(120):
            time.sleep(1)
            try:
                seen = spark.read.schema("chem_id string, expired boolean, n_rows long").parquet(f"{out}/*").where("expired").collect()
            except Exception:  # no batch yet
                seen = []
            if seen:
                break
        assert [(r.chem_id, r.n_rows) for r in seen] == [("a", 1)]
    finally:
        query.stop()
