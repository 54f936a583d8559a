"""All pairs of bit sets whose Tanimoto similarity reaches a limit, by prefix filtering or whole.

Bits are ordered from rare to common. Two sets of a similarity of ``t`` or more share a bit
among the first n - ceil(t n) + 1 of either, n being its size, so only sets that meet in such a prefix are
compared. Where the prefixes' lists hold more pairs than there are pairs of rows, as with dense sets,
one list of all rows takes their place. Lists are cut into runs by size, of bounded length, and runs of fitting
sizes meet as blocks: only pairs that reach the limit leave a task.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import stored
from .blocks import CHUNK

#: Rows of a run: of one size, in one list.
POSTINGS = 4_096
#: In place of a bit: the list of all rows.
ALL = -1


def similar_sets(df: DataFrame, key: str, bits: Column, limit: float, width: int, postings: int = POSTINGS) -> DataFrame:
    """``first_id, second_id, similarity`` of all pairs of rows with a similarity of ``limit`` or more.

    ``bits`` is an array of bit numbers from 0, below ``width``; ``first_id`` is the smaller set, then the smaller id.
    Null keys and null or empty sets are in no pair. Keys must be unique.
    """
    if not 0 < limit <= 1:
        raise ValueError("the limit is over 0 and at most 1")
    sets = df.select(F.col(key).alias("id"), F.array_distinct(bits).alias("bits")).where("id is not null and size(bits) > 0")
    sets = stored(sets, "bit-sets")
    counts = dict(sets.select(F.explode("bits").alias("bit")).groupBy("bit").agg(F.count("*").alias("n")).collect())  # a row a bit
    if any(not 0 <= b < width for b in counts):
        raise ValueError(f"a bit is outside 0 to {width - 1}")
    rare_first = sorted(counts, key=lambda b: (counts[b], b))
    place = {b: k for k, b in enumerate(rare_first)}
    spark = sets.sparkSession
    ranks = spark.createDataFrame([([place.get(b, 0) for b in range(width)],)], "ranks array<int>")
    ordered = sets.crossJoin(F.broadcast(ranks)).withColumn("bits", F.array_sort(F.transform("bits", lambda b: F.get(F.col("ranks"), b.cast("int")))))
    # The set as words of 64 bits in order of rarity, a column each: bit r is bit r % 64 of word r / 64.
    bit = lambda r: F.call_function("shiftleft", F.lit(1).cast("long"), (r % 64).cast("int"))
    words = [f"w{k}" for k in range((width - 1) // 64 + 1)]
    word = lambda k: F.aggregate("bits", F.lit(0).cast("long"), lambda s, r: F.when(F.floor(r / 64) == k, s.bitwiseOR(bit(r))).otherwise(s))
    ordered = stored(ordered.select("id", "bits", *(word(k).alias(w) for k, w in enumerate(words))), "bit-words")
    n = F.size("bits")
    # Rounding must not make a prefix too short.
    prefix = n - F.ceil(F.lit(limit) * n - 1e-9).cast("int") + 1
    listed = ordered.select("id", *words, n.alias("n"), F.explode(F.slice("bits", F.lit(1), prefix)).alias("bit"))
    lists = listed.groupBy("bit", "n").agg(F.count("*").alias("rows")).collect()  # a row a bit and size
    total, sizes = {}, {}
    for r in lists:
        total[r["bit"]] = total.get(r["bit"], 0) + r["rows"]
    rows = ordered.groupBy(n.alias("n")).agg(F.count("*").alias("rows")).collect()
    if sum(x * x for x in total.values()) >= sum(r["rows"] for r in rows) ** 2:
        listed = ordered.select("id", *words, n.alias("n"), F.lit(ALL).alias("bit"))
        lists = [{"bit": ALL, "n": r["n"], "rows": r["rows"]} for r in rows]
    # Each size of a list in runs of at most so many rows, and the pairs of runs whose sizes can fit.
    for r in lists:
        sizes.setdefault(r["bit"], {})[r["n"]] = -(-r["rows"] // postings)
    schema = "bit int, n int, runs int"
    runs = spark.createDataFrame([(b, k, c) for b, by in sizes.items() for k, c in by.items()] or [], schema)
    pairs = spark.createDataFrame([(b, k, m, c, by[m]) for b, by in sizes.items() for k, c in by.items() for m in by if k <= m and k >= limit * m - 1e-9], "bit int, n int, m int, runs int, m_runs int")
    placed = listed.join(F.broadcast(runs), ["bit", "n"]).withColumn("run", F.pmod(F.xxhash64("id"), F.col("runs")).cast("int")).drop("runs")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    # A row goes once to each run it meets: as the smaller set (side 0) and as the larger (side 1).
    small = placed.join(F.broadcast(pairs), ["bit", "n"]).withColumn("m_run", every("m_runs")).select("id", *words, "bit", "n", "m", "run", "m_run", F.lit(0).alias("side"))
    large = placed.withColumnsRenamed({"n": "m", "run": "m_run"}).join(F.broadcast(pairs), ["bit", "m"]).withColumn("run", every("runs"))
    large = large.select("id", *words, "bit", "n", "m", "run", "m_run", F.lit(1).alias("side"))
    # Two runs of one size meet once.
    both = small.unionByName(large).where("n < m or run <= m_run")
    keys = ["bit", "n", "m", "run", "m_run"]
    kind = ordered.schema["id"].dataType.simpleString()
    met = both.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys, "side", "id")
    return met.mapInArrow(_pairs(words, limit), f"first_id {kind}, second_id {kind}, similarity double")


def _pairs(words: list[str], limit: float) -> Callable:
    keys = ["bit", "n", "m", "run", "m_run"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, int, pa.RecordBatch]]:
        for batch in batches:
            at = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in (*keys, "side")], axis=1)
            cuts = np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(at)]):
                if high > low:
                    yield tuple(at[low, :-1].tolist()), int(at[low, -1]), batch.slice(low, high - low)

    def found(key: tuple, x: pa.Table, y: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bit, n, m, run, m_run = key
        a, b = ([np.asarray(t.column(w).to_numpy(**({} if isinstance(t, pa.Table) else {"zero_copy_only": False}))).view(np.uint64) for w in words] for t in (x, y))
        least = np.ceil(limit / (1 + limit) * (n + m) - 1e-9)
        place = None
        if n == m and run == m_run:  # one run with itself: the smaller id first, by place in order of id
            place = pc.index_in(y.column("id"), x.column("id").combine_chunks()).to_numpy()
        for low in range(0, len(x), step := max(1, CHUNK // max(1, len(y)))):
            shared = sum(np.bitwise_count(p[low : low + step, None] & q[None, :]).astype(np.int32) for p, q in zip(a, b))
            i, j = np.nonzero(shared >= least)
            both = shared[i, j]
            i += low
            keep = both / (n + m - both) >= limit - 1e-12
            if bit != ALL:  # a pair counts where its prefixes meet first: no rarer bit is in both
                for k in range(bit // 64 + 1):
                    below = np.uint64((1 << (bit % 64)) - 1 if k == bit // 64 else 0xFFFFFFFFFFFFFFFF)
                    keep &= (a[k][i] & b[k][j] & below) == 0
            if place is not None:
                keep &= i < place[j]
            i, j, both = i[keep], j[keep], both[keep]
            first, second = x.column("id").combine_chunks().take(pa.array(i)), y.column("id").take(pa.array(j))
            if n == m and place is None:  # runs of one size: each pair is met once, in either order
                swap = pc.greater(first, second)
                first, second = pc.if_else(swap, second, first), pc.if_else(swap, first, second)
            yield pa.RecordBatch.from_arrays([first, second, pa.array(both / (n + m - both))], names=["first_id", "second_id", "similarity"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in groupby(pieces(batches), key=lambda p: p[0]):
            some = None
            for side, those in groupby(rows, key=lambda p: p[1]):
                if side == 0:
                    some = pa.Table.from_batches([p[2] for p in those])
                elif some is not None:
                    for p in those:
                        yield from found(key, some, p[2])

    return work


# Functions that run in tasks go there with the task: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
