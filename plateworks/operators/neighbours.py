"""Exact nearest neighbours by cosine distance, with pairs ruled out by the triangle inequality.

On unit vectors the chord, whose square is twice the cosine distance, is a metric. Blocks of
queries meet parts of references (``blocks``). A task takes its references batch by batch and sorts
each batch into cells, by nearest pivot, and these into slices by the chord to the pivot. A query is first compared with
the nearest slices that hold enough references, which bounds its k-th distance; then with those
whose chords to their pivot do not differ from the query's by more than that bound, which falls as
more is seen. Comparisons are matrix products; distances that may count are added up anew,
in order. How much is ruled out depends on the data: much where vectors cluster, little
where they are spread evenly over many dimensions.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import doubles, norm
from . import blocks

PIVOTS = 64
#: References of a cell that are ruled out or compared together, at most; and where a batch is small.
CELL_ROWS, FEWEST = 256, 8
#: Queries of a task: more of them move the references less often.
BLOCK = 16_384
#: What rounding can change of a chord's square.
MARGIN = 1e-8
#: What single precision can change of a cosine, by position; pairs that are compared at once, and references at first.
SINGLE, ROUGH, FIRST = 2.4e-7, 1 << 20, 512
#: Rows of a block where every row is a query.
EVERY_BLOCK = 32_768
#: What nine digits and the order of a sum can change of a distance.
NEAR = 2e-9


def _searches(k: int, pivots: np.ndarray, cell_rows: int, every_pair: bool, others: bool) -> Callable:
    """Work on a block and a part: each query's ``k`` nearest of the part, or every pair that is compared for them."""

    def chords(unit: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 - 2 * unit @ pivots.T, 0))

    def slices(to_pivots: np.ndarray) -> list[np.ndarray]:
        cell = to_pivots.argmin(axis=1)
        order = np.lexsort((to_pivots[np.arange(len(cell)), cell], cell))
        starts = np.flatnonzero(np.diff(cell[order], prepend=-1))
        most = min(cell_rows, max(FEWEST, len(order) // (2 * len(pivots))))
        return [order[low : min(low + most, end)] for start, end in zip(starts, [*starts[1:], len(order)]) for low in range(start, end, most)]

    def work(asked: pa.Table, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, q_norm = blocks.matrix(asked.column("v")), asked.column("norm").to_numpy()
        names, q_unit = asked.column("id").combine_chunks(), q / q_norm[:, None]
        q_chords, q_columns, n = chords(q_unit), np.ascontiguousarray(q.T), len(q)
        # The k-th key and place so far; those kept, in order of query, key and place.
        kth, kth_place = np.full(n, np.inf), np.full(n, np.iinfo(np.int64).max)
        kept, kept_ids, found, found_ids, base = None, None, [], [], 0

        def out(at: np.ndarray, ids: pa.Array, distance: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([names.take(pa.array(at)), ids, pa.array(distance), pa.array(keys)], names=["query_id", "ref_id", "cosine_dist", "_key"])

        def merge() -> None:
            nonlocal kept, kept_ids
            if not found:
                return
            those = [*found] if kept is None else [kept, *found]
            at, keys, places, distance = (np.concatenate([t[c] for t in those]) for c in range(4))
            ids = pa.concat_arrays([*found_ids] if kept is None else [kept_ids, *found_ids])
            order = np.lexsort((places, keys, at))
            at = at[order]
            within = np.arange(len(at)) - np.searchsorted(at, at)
            order, at, within = order[within < k], at[within < k], within[within < k]
            kept, kept_ids = (at, keys[order], places[order], distance[order]), ids.take(pa.array(order))
            last = within == k - 1
            kth[at[last]], kth_place[at[last]] = kept[1][last], kept[2][last]
            found.clear(), found_ids.clear()

        for batch in batches:
            r, r_norm, ids = blocks.matrix(batch.column("v")), batch.column("norm").to_numpy(zero_copy_only=False), batch.column("id")
            unit = r / r_norm[:, None]
            to_pivots, columns = chords(unit), np.ascontiguousarray(r.T)
            parts = slices(to_pivots)
            cells = np.array([to_pivots[p[0]].argmin() for p in parts])
            inner, outer = (np.array([to_pivots[p[e], c] for p, c in zip(parts, cells)]) for e in (0, -1))
            apart = q_chords[:, cells]
            least = np.maximum(apart - outer, inner - apart)
            own = np.full(len(ids), -1)
            if others:
                mine, there = blocks.same(asked.column("id"), ids)
                own[there] = mine

            def compare(wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
                for s, rows in enumerate(parts):
                    every = np.flatnonzero(wanted[:, s])
                    step = max(1, blocks.CHUNK // len(rows))
                    for low in range(0, len(every), step):
                        some = every[low : low + step]
                        if every_pair:
                            at, to = np.repeat(some, len(rows)), np.tile(rows, len(some))
                        else:
                            near = 1 - q_unit[some] @ unit[rows].T <= kth[some][:, None] + NEAR
                            at, to = np.nonzero(near)
                            at, to = some[at], rows[to]
                        if others:
                            at, to = at[own[to] != at], to[own[to] != at]
                        distance = 1 - blocks.exact_dots(q_columns, at, columns, to) / (q_norm[at] * r_norm[to])
                        keys, places = blocks.nine_digits(distance), base + to
                        if every_pair:
                            yield out(at, ids.take(pa.array(to)), distance, keys)
                        better = (keys < kth[at]) | (keys == kth[at]) & (places < kth_place[at])
                        found.append((at[better], keys[better], places[better], distance[better]))
                        found_ids.append(ids.take(pa.array(to[better])))
                        if sum(len(f[0]) for f in found) > max(1 << 18, 2 * n * k):
                            merge()
                merge()

            first = np.zeros(least.shape, bool)
            unbound = np.flatnonzero(np.isinf(kth))
            if len(unbound):
                # The nearest slices that hold k references between them.
                order = np.argsort(np.where(least > 0, apart + least, apart)[unbound], axis=1, kind="stable")
                sizes = np.array([len(p) for p in parts])[order]
                some = np.zeros(order.shape, bool)
                np.put_along_axis(some, order, np.cumsum(sizes, axis=1) - sizes < k + others, axis=1)
                first[unbound] = some
                yield from compare(first)
            yield from compare(~first & (least <= np.sqrt(2 * np.maximum(kth, 0) + MARGIN)[:, None] + MARGIN))
            base += len(ids)
        if kept is not None and not every_pair:
            yield out(kept[0], kept_ids, kept[3], kept[1])

    return work


def _search(queries: DataFrame, references: DataFrame, key: str, vector: str, k: int, pivots: int, cell_rows: int, every_pair: bool, others: bool = False) -> DataFrame:
    spark = references.sparkSession
    sided = lambda df: df.select(F.col(key).alias("id"), doubles(F.col(vector)).alias("v")).withColumn("norm", norm(F.col("v"))).where("norm > 0")
    refs, asked = sided(references), sided(queries)
    # A bounded number of vectors, the same in every run.
    chosen = refs.orderBy(F.xxhash64("id"), "id").limit(pivots).select("v", "norm").collect()
    kinds = [d.schema["id"].dataType.simpleString() for d in (asked, refs)]
    schema = f"query_id {kinds[0]}, ref_id {kinds[1]}, cosine_dist double, _key double"
    if not chosen:
        return spark.createDataFrame([], schema)
    at = np.array([np.array(r["v"]) / r["norm"] for r in chosen])
    n_blocks, n_parts = blocks.grid(asked.count(), spark, BLOCK)
    dealt = blocks.every(blocks.in_blocks(asked, n_blocks), "_part", n_parts), blocks.every(blocks.in_parts(refs, n_parts), "_block", n_blocks)
    return blocks.meet(*dealt, n_parts, _searches(k, at, cell_rows, every_pair, others), schema, n_blocks)


def compared_pairs(queries: DataFrame, references: DataFrame, key: str, vector: str, k: int, pivots: int = PIVOTS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``query_id, ref_id, cosine_dist`` of every pair that ``nearest_pruned`` compares: a query's ``k`` nearest are among them.

    Null and zero vectors have no direction and are left out. Vectors must be equally long.
    """
    return _search(queries, references, key, vector, k, pivots, cell_rows, True).drop("_key")


def nearest_pruned(queries: DataFrame, references: DataFrame, key: str, vector: str, k: int, pivots: int = PIVOTS, cell_rows: int = CELL_ROWS, others: bool = False) -> DataFrame:
    """``query_id, ref_id, cosine_dist, rank``: each query's ``k`` nearest by distance to nine digits, then by id.

    With ``others``, a query is none of its own neighbours. Keys must be unique, vectors equally long; null and zero vectors are left out.
    """
    pairs = _search(queries, references, key, vector, k, pivots, cell_rows, False, others)
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("_key", "ref_id")).cast("long"))
    return ranked.where(F.col("rank") <= k).drop("_key")


def _every_pair(k: int) -> Callable:
    """Work on a block and a part where queries are many: each query's ``k`` nearest other rows of the part.

    Matrix products in single precision tell which pairs can be among the nearest so far, by a
    margin for their rounding; only those are measured.
    """

    def work(asked: pa.Table, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, q_norm = blocks.matrix(asked.column("v")).astype(float), asked.column("norm").to_numpy()
        names, q_rough, q_columns, n = asked.column("id").combine_chunks(), (q / q_norm[:, None]).astype(np.float32), np.ascontiguousarray(q.T), len(q)
        margin = SINGLE * (q.shape[1] + 8)
        # The nearest so far, in order of key and place; inf where there are fewer than k.
        keys, places, distances = np.full((n, k), np.inf), np.full((n, k), np.iinfo(np.int64).max), np.full((n, k), np.inf)
        seen, base = [], 0

        def enter(at: np.ndarray, key: np.ndarray, place: np.ndarray, distance: np.ndarray) -> None:
            """``at`` in order."""
            rows, starts, counts = np.unique(at, return_index=True, return_counts=True)
            wide = k + counts.max()
            new = [np.full((len(rows), wide), fill) for fill in (np.inf, np.iinfo(np.int64).max, np.inf)]
            to = np.repeat(np.arange(len(rows)), counts), k + np.arange(len(at)) - np.repeat(starts, counts)
            for table, old, values in zip(new, (keys, places, distances), (key, place, distance)):
                table[:, :k] = old[rows]
                table[to] = values
            order = np.lexsort((new[1], new[0]), axis=1)[:, :k]
            for table, old in zip(new, (keys, places, distances)):
                old[rows] = np.take_along_axis(table, order, axis=1)

        def pieces() -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
            """A few references at first, then twice as many each time."""
            held, size = [], FIRST
            for batch in batches:
                while batch.num_rows:
                    room = size - sum(b.num_rows for b in held)
                    held.append(batch.slice(0, room))
                    batch = batch.slice(room)
                    if sum(b.num_rows for b in held) == size:
                        yield pa.Table.from_batches(held)
                        held, size = [], min(2 * size, 8 * FIRST)
            if held:
                yield pa.Table.from_batches(held)

        for table in pieces():
            r, r_norm, ids = blocks.matrix(table.column("v")).astype(float), table.column("norm").to_numpy(), table.column("id").combine_chunks()
            rough, columns, own = np.ascontiguousarray((r / r_norm[:, None]).astype(np.float32).T), np.ascontiguousarray(r.T), np.full(n, -1)
            mine, there = blocks.same(asked.column("id"), ids)
            own[mine] = there
            step = max(1, ROUGH // len(ids))
            for low in range(0, n, step):
                near = q_rough[low : low + step] @ rough
                alike = 1 - keys[low : low + step, -1]
                if len(ids) > k + 1 and np.isinf(alike).any():
                    # The (k + 1)-th likest bounds the k-th of the others.
                    alike = np.maximum(alike, np.partition(near, len(ids) - k - 1, axis=1)[:, len(ids) - k - 1])
                # References come in order of id: after k at no distance none is nearer.
                least = np.where(keys[low : low + step, -1] > 0, alike - margin, np.inf).astype(np.float32)
                some = np.flatnonzero(near.max(axis=1) >= least)
                at, to = np.divmod(np.flatnonzero(near[some] >= least[some, None]), len(ids))
                at = low + some[at]
                other = own[at] != to
                at, to = at[other], to[other]
                distance = 1 - blocks.exact_dots(q_columns, at, columns, to) / (q_norm[at] * r_norm[to])
                key = blocks.nine_digits(distance)
                better = key < keys[at, -1]
                if better.any():
                    enter(at[better], key[better], base + to[better], distance[better])
            seen.append(ids)
            base += len(ids)
        if not seen:
            return
        every = pa.concat_arrays(seen)
        at, rank = np.nonzero(np.isfinite(keys))
        for low in range(0, len(at), ROUGH):
            a, c = at[low : low + ROUGH], rank[low : low + ROUGH]
            yield pa.RecordBatch.from_arrays([names.take(pa.array(a)), every.take(pa.array(places[a, c])), pa.array(distances[a, c]), pa.array(keys[a, c])], names=["query_id", "ref_id", "cosine_dist", "_key"])

    return work


def nearest_lists(df: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """``query_id, near``: every row's ``k`` nearest other rows, those by distance to nine digits, then by id, as an array of ``cosine_dist, ref_id`` in order.

    The same as ``nearest_pruned`` of the table with itself, for many queries. Nothing is ruled out by blocks, so
    the cost is that of all pairs. A row without others has no list.
    """
    spark, kind = df.sparkSession, df.schema[vector].dataType.simpleString()
    # Floats go as they are, half as wide.
    vectors = F.col(vector) if kind == "array<float>" else doubles(F.col(vector))
    rows = df.select(F.col(key).alias("id"), vectors.alias("v")).withColumn("norm", norm(doubles(F.col("v")))).where("norm > 0")
    wanted = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    # Nearest rows move once a part, and references once a block: more blocks than parts.
    n_blocks = max(-(-rows.count() // EVERY_BLOCK), min(wanted, math.isqrt(3 * wanted)), 1)
    n_parts = max(1, -(-wanted // n_blocks))
    dealt = blocks.every(blocks.in_blocks(rows, n_blocks), "_part", n_parts), blocks.every(blocks.in_parts(rows, n_parts), "_block", n_blocks)
    named = rows.schema["id"].dataType.simpleString()
    found = blocks.meet(*dealt, n_parts, _every_pair(k), f"query_id {named}, ref_id {named}, cosine_dist double, _key double", n_blocks)
    lists = found.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(F.struct("_key", "ref_id", "cosine_dist"))), 1, k).alias("near"))
    return lists.withColumn("near", F.sort_array(F.transform("near", lambda x: F.struct(x["cosine_dist"].alias("cosine_dist"), x["ref_id"].alias("ref_id")))))


# Functions that run in tasks go there with the task: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
