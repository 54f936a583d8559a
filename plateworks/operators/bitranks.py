"""Ranks of all references by Jaccard distance of sign bits, by counting instead of sorting.

Sets of 64 bits have few distances between them. References are placed in ranges of their ids;
each query's references are counted by distance in every range; sums over these counts say
where a range's ranks begin; and each range numbers its own references. Only counts are shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import bits_of, doubles
from ..storage import stored
from . import blocks

WIDTH = 64
#: Queries whose codes a task works on at once.
ROWS = 64


def _fractions() -> tuple[np.ndarray, np.ndarray]:
    """All distances in order, and the place of each by shared and united bits (flat). Two empty sets are alike."""
    shared, either = np.meshgrid(np.arange(WIDTH + 1.0), np.arange(WIDTH + 1.0), indexing="ij")
    values, at = np.unique(1 - np.where(either > 0, shared / np.maximum(either, 1), 1.0), return_inverse=True)
    return values, at.reshape(-1).astype(np.uint16)


VALUES, CODES = _fractions()
#: Codes after those of distances: no distance as a vector is null, and the query itself, which has no rank.
UNKNOWN, OWN = len(VALUES), len(VALUES) + 1


def words(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    return pc.fill_null(column, 0).to_numpy(zero_copy_only=False).view(np.uint64), column.is_null().to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.is_null().to_numpy()


def codes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places in ``VALUES`` of the distances of every set of a and every of b."""
    a, b = a[:, None], b[None, :]
    return CODES[np.bitwise_count(a & b).astype(np.int32) * (WIDTH + 1) + np.bitwise_count(a | b)]


def _coded(asked: pa.Table, batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """First query and codes, some queries at a time."""
    (q, q_null), (r, r_null) = words(asked.column("bits")), words(batch.column("bits"))
    own, there = blocks.same(asked.column("id"), batch.column("id"))
    for low in range(0, len(q), ROWS):
        found = codes(q[low : low + ROWS], r)
        found[:, r_null] = UNKNOWN
        found[q_null[low : low + ROWS]] = UNKNOWN
        mine = (own >= low) & (own < low + ROWS)
        found[own[mine] - low, there[mine]] = OWN
        yield low, found


def _counts(asked: pa.Table, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((len(asked), OWN + 1), np.int64)
    for batch in batches:
        for low, found in _coded(asked, batch):
            n = len(found)
            total[low : low + n] += np.bincount((found + np.arange(n)[:, None] * (OWN + 1)).ravel(), minlength=n * (OWN + 1)).reshape(n, -1)
    yield pa.RecordBatch.from_arrays([asked.column("id").combine_chunks(), asked.column("part").combine_chunks(), pa.array([t.tobytes() for t in total], pa.binary())], names=["id", "part", "counts"])


def _bases(shared: bool) -> Callable[[pa.Table], pa.Table]:
    """For one query: how many references are before the first of each distance in each range."""

    def run(table: pa.Table) -> pa.Table:
        counts = np.stack([np.frombuffer(c.as_py(), np.int64) for c in table.column("counts")])
        order = np.argsort(table.column("part").to_numpy(), kind="stable")
        total = counts.sum(axis=0)
        base = np.tile(np.cumsum(total) - total, (len(counts), 1))
        if not shared:
            base[order] += np.cumsum(counts[order], axis=0) - counts[order]
        return pa.table([table.column("id"), table.column("part"), pa.array([b.tobytes() for b in base], pa.binary())], names=["id", "part", "base"])

    return run


def _ranks(shared: bool, most: int | None) -> Callable:
    def work(asked: pa.Table, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = np.stack([np.frombuffer(b.as_py(), np.int64) for b in asked.column("base")]).copy()
        names = asked.column("id").combine_chunks()
        for batch in batches:
            for low, found in _coded(asked, batch):
                n, mine = len(found), base[low : low + len(found)]
                rows = np.arange(n)[:, None]
                if shared:
                    at, ranks = np.broadcast_to(np.arange(found.shape[1]), found.shape), mine[rows, found] + 1
                else:
                    at = np.argsort(found, axis=1, kind="stable")
                    found = np.take_along_axis(found, at, axis=1)
                    place = np.broadcast_to(np.arange(found.shape[1]), found.shape)
                    new = np.ones(found.shape, bool)
                    new[:, 1:] = found[:, 1:] != found[:, :-1]
                    # Counted from the first of its distance in the batch.
                    ranks = mine[rows, found] + place - np.maximum.accumulate(np.where(new, place, 0), axis=1) + 1
                    mine += np.bincount((found + rows * (OWN + 1)).ravel(), minlength=n * (OWN + 1)).reshape(n, -1)
                wanted = found != OWN if most is None else (found != OWN) & (ranks <= most)
                q, r = np.nonzero(wanted)
                columns = [names.take(pa.array(q + low)), batch.column("id").take(pa.array(at[wanted])), pa.array(ranks[wanted])]
                if most is not None:
                    columns.append(pa.array(np.append(VALUES, np.nan)[found[wanted]], from_pandas=True))
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "ref_id", "rank", "jaccard_dist"][: len(columns)])

    return work


def bit_ranks(queries: DataFrame, references: DataFrame, key: str, vector: str, shared: bool = False, most: int | None = None) -> DataFrame:
    """``query_id, ref_id, rank``: each query's other references by Jaccard distance of the signs of up to 64 values.

    Ranks are 1, 2, 3, ... with ties by id, or with ``shared`` equal distances share the smallest. With ``most``,
    only ranks up to it, and ``jaccard_dist`` beside them. Null vectors have no distance and come last. Keys must be unique.
    """
    spark = references.sparkSession
    sided = lambda df: df.select(F.col(key).alias("id"), bits_of(doubles(F.col(vector))).alias("bits"))
    asked = sided(queries)
    n_blocks, n_parts = blocks.grid(asked.count(), spark)
    # Written, so that both passes have the same ranges.
    placed = stored(sided(references).repartitionByRange(n_parts, "id").withColumn("_part", F.spark_partition_id()), "ranges-of-ids")
    n_parts = (placed.agg(F.max("_part")).first()[0] or 0) + 1
    asked, refs = blocks.in_blocks(asked, n_blocks), blocks.every(placed, "_block", n_blocks)
    kinds = [d.schema["id"].dataType.simpleString() for d in (asked, placed)]
    dealt = blocks.every(asked, "_part", n_parts).withColumn("part", F.col("_part"))
    counts = blocks.meet(dealt, refs, n_parts, _counts, f"id {kinds[0]}, part int, counts binary", n_blocks)
    bases = stored(counts.groupBy("id").applyInArrow(_bases(shared), f"id {kinds[0]}, part int, base binary"), "bases-of-ranks")
    ready = asked.join(bases, "id").withColumnRenamed("part", "_part")
    schema = f"query_id {kinds[0]}, ref_id {kinds[1]}, rank long" + ("" if most is None else ", jaccard_dist double")
    return blocks.meet(ready, refs, n_parts, _ranks(shared, most), schema, n_blocks)


# Functions that run in tasks go there with the task: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
