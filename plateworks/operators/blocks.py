"""Blocks of queries against parts of references: every pair meets in one task, as a block of a matrix.

Queries are dealt to blocks of bounded size and references to parts; each block meets each
part. A task holds one block of queries and reads its references batch by batch, in order of
their ids, so that its memory does not grow with the tables. Rows move once a block or part.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Queries that a task holds at once.
BLOCK = 4_096
#: Values of a block of distances that are worked on at once.
CHUNK = 1 << 20


def grid(n: int, spark, block: int = BLOCK) -> tuple[int, int]:
    """Numbers of blocks and of parts for ``n`` queries: as many pairs as there are shuffle partitions, or a few more."""
    blocks = max(1, -(-n // block))
    return blocks, max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // blocks))


def in_blocks(df: DataFrame, blocks: int) -> DataFrame:
    return df.withColumn("_block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))


def in_parts(df: DataFrame, parts: int) -> DataFrame:
    # With a constant, so that parts do not follow the blocks or the partitions.
    return df.withColumn("_part", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(parts)).cast("int"))


def every(df: DataFrame, column: str, n: int) -> DataFrame:
    """Each row once for every one of ``n`` blocks or parts."""
    return df.withColumn(column, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def meet(queries: DataFrame, references: DataFrame, parts: int, work: Callable[[pa.Table, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, blocks: int) -> DataFrame:
    """``work(queries of a block, batches of the references of a part in order of id)`` of every block and part.

    Both sides have ``id``, ``_block`` and ``_part``; columns of one side only are null on the other.
    """
    sides = queries.withColumn("_side", F.lit(0)).unionByName(references.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    cell = F.col("_block") * parts + F.col("_part")
    dealt = sides.withColumn("_cell", cell).drop("_block", "_part").repartitionById(blocks * parts, F.col("_cell")).sortWithinPartitions("_cell", "_side", "id")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
        for batch in batches:
            cells, side = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_cell", "_side"))
            cuts = np.flatnonzero(np.diff(cells) | np.diff(side)) + 1
            for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
                if high > low:
                    yield cells[low], side[low], batch.slice(low, high - low)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(pieces(batches), key=lambda p: p[0]):
            asked = None
            for side, those in groupby(rows, key=lambda p: p[1]):
                if side == 0:
                    asked = pa.Table.from_batches([p[2] for p in those])
                elif asked is not None:
                    yield from work(asked, (p[2] for p in those))

    return dealt.mapInArrow(run, schema)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def same(asked: pa.ChunkedArray, refs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Places of a query and a reference with one id."""
    at = pc.index_in(refs, asked.combine_chunks())
    there = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
    return at.take(pa.array(there)).to_numpy(zero_copy_only=False).astype(np.int64), there


def exact_dots(x: np.ndarray, at: np.ndarray, y: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Dot products of rows ``at`` of x and ``to`` of y, added in order as an expression does: matrix products differ from it in the last digits.

    x and y are given with a row a position.
    """
    out = np.zeros(len(at))
    for a, b in zip(x, y):
        out += a[at] * b[to]
    return out


def nine_digits(x: np.ndarray) -> np.ndarray:
    return np.round(x, 9)


# Functions that run in tasks go there with the task: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
