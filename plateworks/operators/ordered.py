"""Running sums, ranks and neighbours over an order of all rows, without a task that holds all rows.

A window without partition keys sends every row to one task. Here rows are dealt by ranges of
the order; each partition sums on its own; the partitions' totals, one row each, give the
bases of the next; and a row's sum is its partition's base and its local one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..storage import stored


def ordered_sums(df: DataFrame, order: list[Column], sums: dict[str, Column], parts: int | None = None) -> DataFrame:
    """``df`` with a column for each of ``sums``: the total over all rows before the row in ``order``.

    Sums are long or double; null values count as zero; the first row has zero. Rows that are equal
    in ``order`` come one after another in any sequence, so give an order that tells them apart where
    that matters. ``parts`` is the number of ranges (default: shuffle partitions); rows equal in
    ``order`` share a range. An empty table stays empty.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    valued = df.withColumns({f"_own_{n}": c for n, c in sums.items()})
    whole = {n: valued.schema[f"_own_{n}"].dataType.typeName() not in ("double", "float", "decimal") for n in sums}
    valued = valued.withColumns({f"_own_{n}": F.coalesce(F.col(f"_own_{n}"), F.lit(0)).cast("long" if whole[n] else "double") for n in sums})
    dealt = valued.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far = dict.fromkeys(whole, 0)
        for batch in batches:
            columns, names = list(batch.columns), list(batch.schema.names)
            for n, is_whole in whole.items():
                kind = np.int64 if is_whole else np.float64
                running = np.cumsum(np.concatenate([[so_far[n]], batch.column(f"_own_{n}").to_numpy(zero_copy_only=False)]).astype(kind))
                columns.append(pa.array(running[:-1]))
                names.append(f"_before_{n}")
                so_far[n] = running[-1]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = StructType([*dealt.schema.fields, *(StructField(f"_before_{n}", LongType() if w else DoubleType()) for n, w in whole.items())])
    # Written, so that the ranges that gave the totals are the ranges of the rows.
    local = stored(dealt.mapInArrow(run, schema), "ordered-sums")
    totals = sorted(local.groupBy("_part").agg(*(F.sum(f"_own_{n}").alias(n) for n in sums)).collect())  # one row a range
    bases, so_far = {}, dict.fromkeys(sums, 0)
    for row in totals:
        bases[row["_part"]] = dict(so_far)
        so_far = {n: so_far[n] + row[n] for n in sums}
    table = pa.table({"_range": pa.array(list(bases), pa.int32())} | {f"_base_{n}": pa.array([b[n] for b in bases.values()], pa.int64() if whole[n] else pa.float64()) for n in sums})
    out = local.join(F.broadcast(spark.createDataFrame(table)), local["_part"] == F.col("_range"))
    return out.select(*df.columns, *((F.col(f"_base_{n}") + F.col(f"_before_{n}")).alias(n) for n in sums))


def ordered_ranks(df: DataFrame, order: list[Column], name: str = "rank", parts: int | None = None) -> DataFrame:
    """``df`` with 1, 2, 3, ... in ``order``."""
    return ordered_sums(df, order, {name: F.lit(1)}, parts).withColumn(name, F.col(name) + 1)


def with_next(df: DataFrame, order: list[Column], columns: dict[str, str], parts: int | None = None) -> DataFrame:
    """``df`` with values of the next row in ``order`` (null for the last): ``columns`` maps new names to columns."""
    ranked = ordered_ranks(df, order, "_at", parts)
    following = ranked.select((F.col("_at") - 1).alias("_at"), *(F.col(c).alias(n) for n, c in columns.items()))
    return ranked.join(following, "_at", "left").drop("_at")
