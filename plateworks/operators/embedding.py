"""A two-dimensional embedding that keeps neighbours: nearest-neighbour graph, fuzzy union, layout by sampled forces.

The graph comes from exact nearest neighbours. A row's neighbours get weights that fall from
one at the nearest, at a scale at which they add up to log2(k); two directions of an edge are
united as fuzzy sets. The layout starts from the principal components. In every epoch an edge pulls its ends
together and pushes its first end from some rows drawn by hash; forces are added up by
row, as whole numbers, so that a second run gives the same places.

Rows are dealt to blocks of bounded size. A task of an epoch holds the edges of one block, with their
draws, and takes the places of all rows block by block; what moves in an epoch is packed edges,
once, and packed places, once a block. Work an epoch is edges times draws.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import stored
from . import blocks, features
from .neighbours import nearest_lists
from .ordered import ordered_ranks

NEIGHBOURS, EPOCHS, DRAWS, RATE = 15, 30, 5, 1.0
#: The curve 1 / (1 + a d^2b) of likeness by distance, for a least distance of 0.1.
CURVE_A, CURVE_B = 1.577, 0.895
#: Forces are clipped to this, and counted in steps of one over ``STEPS``.
MOST, STEPS = 4.0, 1e9
#: Rows of a block: at most, and at least while there are fewer blocks than shuffle partitions. Pairs worked on at once.
BLOCK, SMALL, CHUNK = 32_768, 1_024, 1 << 17


def _weighed(k: int) -> Callable:
    """Each neighbour's weight, by the scale at which those of a row add up to log2 of their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = batch.column("near")
            sizes = near.value_lengths().to_numpy()
            distances, ids = near.flatten().flatten()
            at, rank = np.repeat(np.arange(len(sizes)), sizes), np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            apart = np.full((k, len(sizes)), np.inf)
            apart[rank, at] = distances.to_numpy()
            apart -= apart[0].copy()
            wanted = np.maximum(1.0 + 1e-6, np.log2(sizes))
            low, high = np.full(len(sizes), 1e-9), np.full(len(sizes), 1e3)
            for _ in range(48):
                middle = np.sqrt(low * high)
                over = sum(np.exp(-a / middle) for a in apart) > wanted
                low, high = np.where(over, low, middle), np.where(over, middle, high)
            yield pa.RecordBatch.from_arrays([batch.column("query_id").take(pa.array(at)), ids, pa.array(np.exp(-apart[rank, at] / high[at]))], names=["query_id", "ref_id", "w"])

    return run


def neighbour_graph(df: DataFrame, key: str, vector: str, k: int = NEIGHBOURS) -> DataFrame:
    """``first_id, second_id, weight``: the united edges of each row's ``k`` nearest, in both directions.

    Null and zero vectors have no edges; keys must be unique.
    """
    lists = nearest_lists(df, key, vector, k)
    named = lists.schema["query_id"].dataType.simpleString()
    directed = lists.mapInArrow(_weighed(k), f"query_id {named}, ref_id {named}, w double")
    directed = directed.select(F.least("query_id", "ref_id").alias("a"), F.greatest("query_id", "ref_id").alias("b"), (F.col("query_id") < F.col("ref_id")).alias("up"), "w")
    p, q = (F.coalesce(F.max(F.when(F.col("up") == up, F.col("w"))), F.lit(0.0)) for up in (True, False))
    united = directed.groupBy("a", "b").agg((p + q - p * q).alias("weight")).where("weight > 1e-6")
    united = stored(united, "neighbour-graph")
    return united.select(F.col("a").alias("first_id"), F.col("b").alias("second_id"), "weight").unionByName(united.select(F.col("b").alias("first_id"), F.col("a").alias("second_id"), "weight"))


_PRIMES = [np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def hashed(x: np.ndarray | int, before: np.ndarray, longs: bool) -> np.ndarray:
    """``xxhash64`` of one more column of longs or ints, from the hash of the columns before it (42 for none), as unsigned numbers."""
    p1, p2, p3, p4, p5 = _PRIMES
    turned = lambda v, by: (v << np.uint64(by)) | (v >> np.uint64(64 - by))
    x = np.asarray(x, np.int64).astype(np.uint64)
    with np.errstate(over="ignore"):
        if longs:
            h = turned((before + p5 + np.uint64(8)) ^ turned(x * p2, 31) * p1, 27) * p1 + p4
        else:
            h = turned((before + p5 + np.uint64(4)) ^ (x & np.uint64(0xFFFFFFFF)) * p1, 23) * p2 + p3
        h = (h ^ h >> np.uint64(33)) * p2
        h = (h ^ h >> np.uint64(29)) * p3
    return h ^ h >> np.uint64(32)


def _doubles(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows))


def _whole(forces: np.ndarray) -> np.ndarray:
    return np.rint(forces * STEPS).astype(np.int64)


def _epoch(n: int, n_blocks: int, epoch: int, epochs: int, draws: int, rate: float, seed: int) -> Callable:
    """Work on a block: its edges, then its own places, then those of every block; gives its places after the epoch."""

    def added(own: np.ndarray, w: np.ndarray, i: np.ndarray, pair: np.ndarray, to: np.ndarray, there: np.ndarray, forces: np.ndarray) -> None:
        """Forces of the targets ``pair`` (edge, and draw times edges) that are at places ``to`` of ``there``."""
        for low in range(0, len(pair), CHUNK):
            edge = pair[low : low + CHUNK] % len(i)
            at = i[edge]
            apart = own[:, at] - there[:, to[low : low + CHUNK]]
            square = apart[0] * apart[0] + apart[1] * apart[1]
            curve = 1 + CURVE_A * square**CURVE_B
            strength = 2 * CURVE_B / ((square + 0.001) * curve)
            pulls = np.flatnonzero(pair[low : low + CHUNK] < len(i))
            s = square[pulls]
            with np.errstate(divide="ignore"):
                strength[pulls] = np.where(s > 0, -2 * 2 * CURVE_A * CURVE_B * s ** (CURVE_B - 1) / curve[pulls], 0.0)
            for force, d in zip(forces, apart):
                np.add.at(force, at, _whole(np.clip(strength * d, -MOST, MOST) * w[edge]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, own, block = ([], [], []), None, None
        for batch in batches:
            for row in range(batch.num_rows):
                block, piece, *packed = (batch.column(c)[row].as_py() for c in ("_block", "piece", "i", "j", "w", "x", "y"))
                if piece is None:
                    for those, more in zip(edges, packed):
                        those.append(more)
                    continue
                there = np.stack([_doubles([c]) for c in packed[3:]])
                if own is None:
                    # The first is the block's own.
                    own, forces = there, np.zeros(there.shape, np.int64)
                    i, j = (np.frombuffer(b"".join(e), np.int64) for e in edges[:2])
                    w, mine = _doubles(edges[2]), i * n_blocks + block
                    edges = None
                    held = np.zeros(own.shape[1], np.int64)
                    np.add.at(held, i, _whole(w))
                    start = hashed(epoch, hashed(seed, hashed(j, hashed(mine, np.uint64(42), True), True), False), False)
                    targets = np.concatenate([j, *(hashed(s, start, False).astype(np.int64) % n for s in range(draws))])
                    of = (targets % n_blocks).astype(np.int16 if n_blocks < 1 << 15 else np.int64)
                    # Those of a block one after another; none is the row itself.
                    order = np.argsort(of, kind="stable")
                    order = order[targets[order] != np.tile(mine, draws + 1)[order]]
                    ends = np.concatenate([[0], np.cumsum(np.bincount(of[order], minlength=n_blocks))])
                    targets //= n_blocks
                    del start, of, mine, j
                if len(i):
                    pair = order[ends[piece] : ends[piece + 1]]
                    added(own, w, i, pair, targets[pair], there, forces)
        if own is not None:
            step = rate * (1 - epoch / epochs)
            after = np.round(own + step * np.clip(3 * forces / STEPS / np.maximum(held / STEPS, 1.0), -MOST, MOST), 9)
            yield pa.RecordBatch.from_pydict({"piece": pa.array([block], pa.int32()), "x": [after[0].tobytes()], "y": [after[1].tobytes()]})

    return run


def _packed_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        block = batch.column("_block").to_numpy()
        for low, high in zip(cuts := [0, *(np.flatnonzero(np.diff(block)) + 1)], [*cuts[1:], len(block)]):
            if high > low:
                i, j, w = (batch.column(c).to_numpy()[low:high].tobytes() for c in ("i", "j", "w"))
                yield pa.RecordBatch.from_pydict({"_block": pa.array([block[low]], pa.int32()), "i": [i], "j": [j], "w": [w]})


def _packed_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = list(batches)
    if any(b.num_rows for b in rows):
        # A partition is one block.
        table = pa.Table.from_batches(rows).sort_by("i")
        x, y = (table.column(c).to_numpy().tobytes() for c in ("x", "y"))
        yield pa.RecordBatch.from_pydict({"piece": table.column("_block").slice(0, 1).combine_chunks(), "x": [x], "y": [y]})


def _unpacked(n_blocks: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, y = np.frombuffer(row["x"]), np.frombuffer(row["y"])
                yield pa.RecordBatch.from_pydict({"number": np.arange(len(x)) * n_blocks + row["piece"], "x": x, "y": y})

    return run


def _projected(axes: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns, out = blocks.matrix(batch.column("v")).astype(float).T, np.zeros((axes.shape[1], batch.num_rows))
                for values, weights in zip(columns, axes):
                    out += weights[:, None] * values
                yield pa.RecordBatch.from_arrays([batch.column("number"), pa.array(out[0]), pa.array(out[1])], names=["number", "x", "y"])

    return run


def embed(df: DataFrame, key: str, vector: str, k: int = NEIGHBOURS, epochs: int = EPOCHS, draws: int = DRAWS, rate: float = RATE, seed: int = 1) -> DataFrame:
    """``id, x, y`` of every row with a vector that is neither null nor zero; ``id`` is the key. Two runs give the same rows."""
    there = df.select(F.col(key).alias("id"), F.col(vector).alias("v")).where("v is not null").where(F.exists("v", lambda x: x != 0))
    numbered = ordered_ranks(there, [F.asc("id")], "number").withColumn("number", F.col("number") - 1)
    n, axes = features.components(numbered, "v", 2)
    if not n:
        return there.select("id", F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    start = numbered.select("number", "v").mapInArrow(_projected(axes), "number long, x double, y double")
    widest = start.agg(F.max(F.greatest(F.abs("x"), F.abs("y")))).first()[0]
    n_blocks = max(-(-n // BLOCK), min(-(-n // SMALL), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    block = lambda c: F.pmod(F.col(c), F.lit(n_blocks)).cast("int")
    within = lambda c: F.floor(F.col(c) / F.lit(n_blocks)).cast("long")
    spread = lambda c: F.round(F.col(c) * F.lit(10.0 / max(widest, 1e-12)), 9)
    at = start.select(block("number").alias("_block"), within("number").alias("i"), spread("x").alias("x"), spread("y").alias("y"))
    at = at.repartitionById(n_blocks, F.col("_block")).mapInArrow(_packed_places, "piece int, x binary, y binary")
    edges = neighbour_graph(numbered, "number", "v", k).select(block("first_id").alias("_block"), within("first_id").alias("i"), F.col("second_id").alias("j"), F.col("weight").alias("w"))
    edges = stored(edges.repartitionById(n_blocks, F.col("_block")).mapInArrow(_packed_edges, "_block int, i binary, j binary, w binary"), "embedding-edges")
    for epoch in range(epochs):
        # A block's own places come before the others'.
        places = at.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).withColumn("_turn", F.when(F.col("piece") == F.col("_block"), 0).otherwise(1))
        sides = edges.withColumn("_turn", F.lit(-1)).unionByName(places, allowMissingColumns=True)
        dealt = sides.repartitionById(n_blocks, F.col("_block")).sortWithinPartitions("_turn")
        at = dealt.mapInArrow(_epoch(n, n_blocks, epoch, epochs, draws, rate, seed), "piece int, x binary, y binary")
    placed = at.mapInArrow(_unpacked(n_blocks), "number long, x double, y double")
    return numbered.select("number", "id").join(placed, "number").select("id", "x", "y")


def trustworthiness(near_before: DataFrame, near_after: DataFrame, k: int, n: int) -> DataFrame:
    """``trustworthiness`` of an embedding of ``n`` rows, from ``query_id, ref_id, rank`` of all pairs before and of the ``k`` nearest after."""
    met = near_after.where(F.col("rank") <= k).select("query_id", "ref_id").join(near_before.select("query_id", "ref_id", F.col("rank").alias("_was")), ["query_id", "ref_id"])
    excess = F.coalesce(F.sum(F.greatest(F.lit(0), F.col("_was") - k)), F.lit(0))
    return met.agg((1 - F.lit(2.0 / (n * k * (2 * n - 3 * k - 1))) * excess).alias("trustworthiness"))


# Functions that run in tasks go there with the task: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
