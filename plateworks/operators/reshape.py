"""Set operations, pivots, and other changes of shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import quantiles


def stack(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames by column name; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def venn(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Distinct keys only in the first, in both, only in the second."""
    marked = first.select(key, F.lit(1).alias("a"), F.lit(0).alias("b")).union(second.select(key, F.lit(0), F.lit(1)))
    seen = marked.groupBy(key).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    one = lambda c, n: F.sum(F.when(c, 1).otherwise(0)).alias(n)
    return seen.agg(one((F.col("a") == 1) & (F.col("b") == 0), "only_first"), one((F.col("a") == 1) & (F.col("b") == 1), "both"), one((F.col("a") == 0) & (F.col("b") == 1), "only_second"))


def widen(df: DataFrame, keys: list[str], column: str, values: list, agg: Column) -> DataFrame:
    """An explicit pivot: one pass, a fixed schema."""
    return df.groupBy(*keys).pivot(column, values).agg(agg)


def lengthen(df: DataFrame, keys: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot(keys, columns, name, value)


def counted(df: DataFrame, column: Column, name: str) -> DataFrame:
    return df.groupBy(column.alias(name)).agg(F.count("*").alias("n"))


def shares(df: DataFrame, group: str, by: str) -> DataFrame:
    """Counts of ``by`` within ``group`` and their share of the group."""
    n = df.groupBy(group, by).agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(group)))


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Least value, exact quartiles and largest value of each group; NaN values do not count."""
    return quantiles(df, value, {"low": 0.0, "q25": 0.25, "q50": 0.5, "q75": 0.75, "high": 1.0}, [group]).drop("n")


def clip_to_quartiles(df: DataFrame, column: str) -> DataFrame:
    """``column`` held between its exact quartiles, which are one row, read back as two numbers."""
    low, high = quantiles(df, column, {"low": 0.25, "high": 0.75}).select("low", "high").first()
    return df.withColumn("clipped", F.greatest(F.lit(low), F.least(F.lit(high), F.col(column))))


def histogram(df: DataFrame, value: str, width: float = 1.0) -> DataFrame:
    """Counts in bins centred on multiples of ``width``."""
    return df.groupBy((F.floor((F.col(value) + width / 2) / width)).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def histogram2d(df: DataFrame, first: str, second: str, widths: tuple[float, float]) -> DataFrame:
    """Joint counts in bins from zero."""
    bins = [F.floor(F.col(c) / w).cast("long").alias(n) for c, w, n in ((first, widths[0], "bin_a"), (second, widths[1], "bin_b"))]
    return df.groupBy(*bins).agg(F.count("*").alias("n"))


def grouped_lists(df: DataFrame, group: str, member: str) -> DataFrame:
    """Members of each group in order. For groups that fit in a row."""
    return df.groupBy(group).agg(F.sort_array(F.collect_list(member)).alias("members"))


def labelled(df: DataFrame, column: str, labels: dict[str, str], default: str | None = None) -> DataFrame:
    """``label`` of a column's values by a small map; others get ``default``."""
    names = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return df.withColumn("label", F.coalesce(names[F.col(column)], F.lit(default)))


def least_ranked(df: DataFrame, group: str, value: str) -> DataFrame:
    """Rows that hold their group's least value; ties are kept."""
    return df.withColumn("_m", F.min(value).over(Window.partitionBy(group))).where(F.col(value) == F.col("_m")).drop("_m")


def transposed(df: DataFrame, key: str, values: list[str], names: list[str]) -> DataFrame:
    """Rows as columns: ``field`` and a column for each of ``names`` (values of ``key``)."""
    long = df.select(F.col(key).cast("string").alias("_key"), *(F.col(v).cast("double").alias(v) for v in values)).unpivot(["_key"], values, "field", "_value")
    return long.groupBy("field").pivot("_key", names).agg(F.first("_value"))


def best_of_group(df: DataFrame, group: str, by: str, order: str) -> DataFrame:
    """Per group the first row (by ``order``, of any type) of the largest ``by``; null values come last."""
    # A struct's minimum, so that partial results are one row a group: the largest value is found first.
    best = df.groupBy(F.col(group).alias("_group")).agg(F.max(by).alias("_best"))
    among = df.join(best, df[group].eqNullSafe(F.col("_group")) & df[by].eqNullSafe(F.col("_best"))).drop("_group", "_best")
    first = among.groupBy(group).agg(F.min_by(F.struct(*df.columns), F.struct(F.col(order).isNull(), F.col(order))).alias("best"))
    return first.select("best.*")
