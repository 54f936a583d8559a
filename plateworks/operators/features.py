"""Feature pruning on vectors held as arrays: one row a compound, positions as keys."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exploded(df: DataFrame, vector: str) -> DataFrame:
    return df.select(F.posexplode(vector).alias("pos", "x")).select(F.col("pos").cast("long").alias("pos"), F.col("x").cast("double").alias("x"))


def variances(df: DataFrame, vector: str) -> DataFrame:
    """Sample variance of every position."""
    return exploded(df, vector).groupBy("pos").agg(F.var_samp("x").alias("variance"))


def bit_counts(df: DataFrame, vector: str) -> DataFrame:
    """Compounds that have each bit (value over zero)."""
    return exploded(df, vector).groupBy("pos").agg(F.sum((F.col("x") > 0).cast("long")).alias("n"))


def correlations(df: DataFrame, vector: str, width: int) -> DataFrame:
    """Signed correlation of every two positions i < j, from one matrix of sums a partition: only these are shuffled."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, product = 0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            for row in batch.to_pylist():
                n, total, product = n + row["n"], total + np.array(row["total"]), product + np.array(row["product"]).reshape(width, width)
        if n:
            cov = product - np.outer(total, total) / n
            spread = np.sqrt(np.maximum(np.diag(cov), 0))
            with np.errstate(invalid="ignore", divide="ignore"):
                r = cov / np.outer(spread, spread)
            i, j = np.triu_indices(width, 1)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(r[i, j], from_pandas=True)], names=["i", "j", "r"])

    read = df.select(F.transform(vector, lambda x: x.cast("double")).alias("v"))
    first = read.where("v is not null").first()
    origin = np.array(first["v"] if first else np.zeros(width))
    return _moments(read, width, origin).coalesce(1).mapInArrow(merge, "i long, j long, r double")


def _moments(read: DataFrame, width: int, origin: np.ndarray) -> DataFrame:
    """``one, n, total, product``: sums of the vectors ``v`` and of their products about ``origin``, in a few rows."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, product = 0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                rows = [r for r in batch.column(0).slice(at, 1024).to_pylist() if r is not None]
                if rows:
                    # About the first row seen, so that large means do not swallow the products.
                    x = np.array(rows, float) - origin
                    n, total, product = n + len(x), total + x.sum(axis=0), product + x.T @ x
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([n]), pa.array([total.tolist()]), pa.array([product.ravel().tolist()])], names=["one", "n", "total", "product"])

    parts = read.mapInArrow(sums, "one long, n long, total array<double>, product array<double>")
    # A tree of two levels: square roots of the number of partitions meet.
    some = max(1, math.isqrt(max(1, int(read.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    return parts.repartition(some).mapInArrow(_added(width), "one long, n long, total array<double>, product array<double>")


def components(df: DataFrame, vector: str, k: int = 2) -> tuple[int, np.ndarray]:
    """The number of rows and the first ``k`` principal components, as columns, in one pass; those that vectors are too short for are zero."""
    read = df.select(F.transform(vector, lambda x: x.cast("double")).alias("v"))
    first = read.first()
    if first is None:
        return 0, np.zeros((0, k))
    width = len(first["v"])
    rows = _moments(read, width, np.array(first["v"])).collect()
    n, total, product = sum(r["n"] for r in rows), *(np.sum([r[c] for r in rows], axis=0) for c in ("total", "product"))
    covariance = (product.reshape(width, width) - np.outer(total, total) / n) / max(n - 1, 1)
    out = np.zeros((width, k))
    found = np.linalg.svd(covariance)[0][:, :k]
    out[:, : found.shape[1]] = found
    return n, out


def _added(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, product = 0, np.zeros(width), np.zeros(width * width)
        for batch in batches:
            for row in batch.to_pylist():
                n, total, product = n + row["n"], total + np.array(row["total"]), product + np.array(row["product"])
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([n]), pa.array([total.tolist()]), pa.array([product.tolist()])], names=["one", "n", "total", "product"])

    return run


def correlated(df: DataFrame, vector: str, width: int, limit: float) -> DataFrame:
    """Positions to drop: those that correlate, with sign, at ``limit`` or more with an earlier one."""
    return correlations(df, vector, width).where(F.col("r") >= limit).select(F.col("j").cast("long").alias("pos")).distinct()


def _marks(column: pa.Array, width: int) -> np.ndarray:
    """Which of ``width`` positions of each row's vector are over zero; null vectors and missing positions are not."""
    size = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
    values = np.nan_to_num(column.flatten().to_numpy(zero_copy_only=False).astype(float)) > 0
    at = np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)
    out = np.zeros((len(column), width), np.float32)
    inside = at < width
    out[np.repeat(np.arange(len(size)), size)[inside], at[inside]] = values[inside]
    return out


def hamming_features(df: DataFrame, vector: str, width: int | None = None) -> DataFrame:
    """Share of compounds in which two bits i < j of ``width`` differ; bits that none has count too.

    Without ``width`` it is that of the longest vector. Each partition adds up one matrix of
    counts, so what is shuffled does not depend on how many bits are set.
    """
    seen = df.agg(F.count("*").alias("n"), F.max(F.size(vector)).alias("width")).first()
    n, width = seen["n"], width or max(seen["width"] or 0, 1)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        differ = np.zeros((width, width), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                x = _marks(batch.column(0).slice(at, 4096), width)
                ones = x.sum(axis=0)
                differ += (ones[:, None] + ones[None, :] - 2 * (x.T @ x)).astype(np.int64)
        i, j = np.triu_indices(width, 1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(differ[i, j])], names=["i", "j", "differ"])

    # No task runs for an empty table, and every pair has its row all the same.
    every = df.sparkSession.range(width).select(F.col("id").alias("i")).withColumn("j", F.explode(F.sequence(F.col("i"), F.lit(width - 1).cast("long")))).where("i < j").withColumn("differ", F.lit(0).cast("long"))
    summed = df.select(vector).mapInArrow(counts, "i long, j long, differ long").unionByName(every).groupBy("i", "j").agg(F.sum("differ").alias("differ"))
    return summed.select("i", "j", (F.col("differ") / F.lit(float(max(n, 1)))).alias("hamming"))


def keep_positions(df: DataFrame, vector: str, keep: list[int]) -> DataFrame:
    return df.withColumn(vector, F.transform(F.array(*map(F.lit, keep)), lambda k: F.get(F.col(vector), k)))


def project(df: DataFrame, vector: str, k: int = 2) -> DataFrame:
    """``projection``: the first ``k`` principal components (a linear stand-in for a neighbour embedding)."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    ready = df.withColumn("_v", array_to_vector(F.transform(vector, lambda x: x.cast("double"))))
    out = PCA(k=k, inputCol="_v", outputCol="_p").fit(ready).transform(ready)
    return out.withColumn("projection", vector_to_array("_p")).drop("_v", "_p")


# Functions that run in tasks go there with the task: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
