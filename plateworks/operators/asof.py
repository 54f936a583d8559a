"""Joins of two tables by the nearest time.

Both sides go through one order of group and time. A running count of the right side's
different times tells each left row how many lie before it, and so which two are next to it:
two joins on that number give the times on either side, and a join on the time the rows. The
count is taken over ranges of the order (``ordered``), so neither a long series nor a group
that holds most rows is in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from .ordered import ordered_sums


def _axis(df: DataFrame, column: str) -> Column:
    """A time as a number: microseconds of dates and timestamps, numbers as they are."""
    kind = df.schema[column].dataType
    timed = isinstance(kind, (DateType, TimestampType, TimestampNTZType))
    return F.unix_micros(F.col(column).cast("timestamp")) if timed else F.col(column).cast("double")


def nearest_time_join(
    left: DataFrame, right: DataFrame, left_time: str, right_time: str, by: dict[str, str] | None = None, how: str = "nearest", within: float | None = None, prefix: str = "near_", parts: int | None = None
) -> DataFrame:
    """Every row of ``left`` with the rows of ``right`` at the nearest time, whose columns get ``prefix``.

    ``how`` is ``nearest`` (either side), ``backward`` (the latest at or before) or ``forward`` (the
    earliest at or after); ``by`` maps columns of ``left`` to columns of ``right`` that must be equal;
    ``within`` is the largest distance (microseconds for times). All rows at the nearest time are joined, those of
    both sides if both are equally near. A left row without any, or with a null time or group, stays once with nulls; right
    rows with a null time or group are never joined.
    """
    if how not in ("nearest", "backward", "forward"):
        raise ValueError(f"how is {how}")
    by = by or {}
    keys = [f"_k{n}" for n in range(len(by))]
    rows = left.select(F.struct(*left.columns).alias("_row"), _axis(left, left_time).alias("_t"), *(F.col(c).alias(k) for c, k in zip(by, keys)))
    others = right.select(F.struct(*(F.col(c).alias(f"{prefix}{c}") for c in right.columns)).alias("_other"), _axis(right, right_time).alias("_t"), *(F.col(c).alias(k) for c, k in zip(by.values(), keys)))
    others = others.na.drop(subset=["_t", *keys])
    able = F.col("_t").isNotNull()
    for k in keys:
        able = able & F.col(k).isNotNull()
    # Different times of the right side come before left rows of the same time; equal left rows are told apart by where they stand.
    marks = others.select("_t", *keys).distinct().withColumns({"_side": F.lit(0), "_at": F.lit(0).cast("long")})
    both = rows.where(able).withColumns({"_side": F.lit(1), "_at": F.monotonically_increasing_id()}).unionByName(marks, allowMissingColumns=True)
    counted = ordered_sums(both, [*map(F.asc, keys), F.asc("_t"), F.asc("_side"), F.asc("_at")], {"_n": F.when(F.col("_side") == 0, 1).otherwise(0)}, parts)
    ranked = counted.where("_side = 0").select((F.col("_n") + 1).alias("_rank"), "_t", *keys)
    rows_at = counted.where("_side = 1").drop("_side", "_at")

    def beside(df: DataFrame, rank: Column, name: str) -> DataFrame:
        there = ranked.select(F.col("_rank").alias("_r"), F.col("_t").alias(name), *(F.col(k).alias(f"{k}_") for k in keys))
        same = rank == F.col("_r")
        for k in keys:
            same = same & (F.col(k) == F.col(f"{k}_"))
        return df.join(there, same, "left").drop("_r", *(f"{k}_" for k in keys))

    placed = beside(beside(rows_at, F.col("_n"), "_before"), F.col("_n") + 1, "_after")
    back, ahead = F.col("_t") - F.col("_before"), F.col("_after") - F.col("_t")
    ahead = F.when(back == 0, back).otherwise(ahead) if how == "forward" else ahead
    least = {"nearest": F.least(back, ahead), "backward": back, "forward": ahead}[how]
    least = least if within is None else F.when(least <= within, least)
    take_back, take_ahead = F.lit(how != "forward") & (back == least) | (back == 0) & (least == 0), F.lit(how != "backward") & (F.col("_after") - F.col("_t") == least)
    times = F.array_compact(F.array(F.when(take_back, F.col("_before")), F.when(take_ahead, F.col("_after"))))
    placed = placed.withColumn("_times", times)
    found = placed.where(F.size("_times") > 0).select("_row", *keys, F.explode("_times").alias("_t")).join(others, ["_t", *keys])
    alone = placed.where(F.size("_times") == 0).select("_row").union(rows.where(~able).select("_row")).withColumn("_other", F.lit(None).cast(others.schema["_other"].dataType))
    return found.select("_row", "_other").union(alone).select("_row.*", "_other.*")
