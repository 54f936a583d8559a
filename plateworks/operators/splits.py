"""Train, validation and test splits."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import ordered_ranks


def group_split(df: DataFrame, group: str, key: str, train: float = 0.8, valid: float = 0.1) -> DataFrame:
    """Whole groups to splits, the largest first: train while it fits, then validation while train and validation
    together fit in both shares, else test. Groups of equal size go by their first key, larger first.

    Groups of one size that do not fit any more stay out for good, so only the number of groups of
    each size decides: the fold runs over sizes (at most the square root of twice the rows). Ranks are
    taken only within the sizes that are divided, over ranges. Null groups are one group.
    """
    sizes = df.groupBy(F.col(group).alias("_group")).agg(F.count("*").alias("_n"), F.min(key).alias("_first"))
    counts = sizes.groupBy("_n").agg(F.count("*").alias("c")).orderBy(F.desc("_n")).collect()
    total = sum(r["_n"] * r["c"] for r in counts)
    most, most_both = math.floor(train * total), math.floor((train + valid) * total)
    in_train = in_valid = 0
    to_train, to_valid = {}, {}
    for r in counts:
        n, c = r["_n"], r["c"]
        to_train[n] = min(c, max(0, most - in_train) // n)
        in_train += n * to_train[n]
        to_valid[n] = min(c - to_train[n], max(0, most_both - in_train - in_valid) // n)
        in_valid += n * to_valid[n]
    fates = pa.table(
        [pa.array([r["_n"] for r in counts], pa.int64()), pa.array([to_train[r["_n"]] for r in counts], pa.int64()), pa.array([to_train[r["_n"]] + to_valid[r["_n"]] for r in counts], pa.int64()), pa.array([r["c"] for r in counts], pa.int64())],
        names=["_size", "_t", "_v", "_c"],
    )
    known = sizes.join(df.sparkSession.createDataFrame(fates), F.col("_n") == F.col("_size"))
    whole = (F.col("_t") == F.col("_c")) | ((F.col("_t") == 0) & (F.col("_v").isin(0) | (F.col("_v") == F.col("_c"))))
    fate = lambda rank: F.when(rank <= F.col("_t"), "train").when(rank <= F.col("_v"), "valid").otherwise("test")
    # Ranks within sizes: places over ranges of size and first key, less what comes before the size.
    placed = ordered_ranks(known.where(~whole), [F.asc("_n"), F.desc("_first")], "_place")
    starts = placed.groupBy(F.col("_n").alias("_of")).agg((F.min("_place") - 1).alias("_start"))
    placed = placed.join(starts, F.col("_n") == F.col("_of"))
    split = known.where(whole).select("_group", fate(F.lit(1)).alias("split")).union(placed.select("_group", fate(F.col("_place") - F.col("_start")).alias("split")))
    return df.join(split, df[group].eqNullSafe(F.col("_group")), "left").drop("_group")


def exact_split(df: DataFrame, order: Column, valid: float = 0.1, test: float = 0.1) -> DataFrame:
    """Exactly floor(share * n) rows to validation, then to test, the rest to train, by ``order`` (hex digits, see ``seeded``).

    Ranks come from counts by the first four digits, of which there are 65,536 at most, and
    from windows within these, so no task holds all rows.
    """
    marked = df.withColumn("_o", order).withColumn("_b", F.substring("_o", 1, 4))
    counts = marked.groupBy("_b").agg(F.count("*").alias("_c"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_b", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_s"), F.sum("_c").over(Window.partitionBy()).alias("_n"))
    placed = marked.join(F.broadcast(starts), "_b").withColumn("_k", F.col("_s") + F.row_number().over(Window.partitionBy("_b").orderBy("_o")))
    v, t = F.floor(F.lit(valid) * F.col("_n")), F.floor(F.lit(test) * F.col("_n"))
    out = placed.withColumn("split", F.when(F.col("_k") <= v, "valid").when(F.col("_k") <= v + t, "test").otherwise("train"))
    return out.select(*df.columns, "split")


def seeded(key: str, seed: int) -> Column:
    """An order that looks random and is the same in every run (and in other engines)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def label_split(df: DataFrame, train: DataFrame, valid: DataFrame, key: str) -> DataFrame:
    """"train" if the key is in ``train``, else "valid" if in ``valid``, else "test"."""
    t = train.select(F.col(key).alias("_t")).distinct()
    v = valid.select(F.col(key).alias("_v")).distinct()
    out = df.join(t, df[key] == F.col("_t"), "left").join(v, df[key] == F.col("_v"), "left")
    return out.withColumn("split", F.when(F.col("_t").isNotNull(), "train").when(F.col("_v").isNotNull(), "valid").otherwise("test")).drop("_t", "_v")
