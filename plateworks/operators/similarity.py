"""Distances from query compounds to reference compounds, and ranks by them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import bit_distance, bits_of, cosine_distance, doubles, norm
from .ordered import ordered_ranks

#: A query table of up to this many rows is sent whole to every executor; a larger one is dealt in blocks of so many.
QUERY_LIMIT = 5_000


def against_all(queries: DataFrame, references: DataFrame, key: str, limit: int = QUERY_LIMIT) -> DataFrame:
    """A stated query set against all references. Columns must differ; ``key`` is the queries' id.

    Few queries are broadcast. More are dealt in blocks of about ``limit``, and every block meets the references in as many parts as there are shuffle partitions.
    """
    n = queries.count()
    if n <= limit:
        return references.crossJoin(F.broadcast(queries))
    blocks, parts = -(-n // limit), int(references.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = queries.withColumn("_block", F.pmod(F.xxhash64(key), F.lit(blocks))).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    spread = references.withColumn("_part", F.pmod(F.xxhash64(*references.columns[:1]), F.lit(parts)))
    spread = spread.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    return spread.join(dealt, ["_block", "_part"]).drop("_block", "_part")


def prepared(df: DataFrame, key: str, vector: str, prefix: str) -> DataFrame:
    """Key, vector as doubles, its norm and its sign bits, each computed once per row."""
    v = doubles(F.col(vector))
    return df.select(F.col(key).alias(f"{prefix}_id"), v.alias(f"{prefix}_v"), norm(v).alias(f"{prefix}_norm"), bits_of(v).alias(f"{prefix}_bits"))


def distances(queries: DataFrame, references: DataFrame, key: str, vector: str, limit: int = QUERY_LIMIT) -> DataFrame:
    """``query_id, ref_id, cosine_dist, jaccard_dist``: a stated query set against all references."""
    q, r = prepared(queries, key, vector, "query"), prepared(references, key, vector, "ref")
    return against_all(q, r, "query_id", limit).select(
        "query_id",
        "ref_id",
        cosine_distance(F.col("query_v"), F.col("ref_v"), F.col("query_norm"), F.col("ref_norm")).alias("cosine_dist"),
        bit_distance(F.col("query_bits"), F.col("ref_bits")).alias("jaccard_dist"),
    )


def rank_first(df: DataFrame, by: Column, tie: list[str], name: str, group: str = "query_id") -> DataFrame:
    """Ordinal ranks per query; ties by the ``tie`` columns."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(by, *tie)).cast("long"))


def rank_shared(df: DataFrame, by: Column, name: str, group: str = "query_id") -> DataFrame:
    """Ranks per query where equal values share the smallest."""
    return df.withColumn(name, F.rank().over(Window.partitionBy(group).orderBy(by)).cast("long"))


def nearest(df: DataFrame, metric: str, k: int, group: str = "query_id", tie: str = "ref_id") -> DataFrame:
    return rank_first(df, F.col(metric), [tie], "rank", group).where(F.col("rank") <= k)


def full_ranks(df: DataFrame, by: str, tie: list[str], name: str, group: str = "query_id") -> DataFrame:
    """``rank_first`` for rows that all are wanted: over ranges of group and value, so that no task sorts all rows of a group."""
    ranked = ordered_ranks(df, [F.asc(group), F.asc(by), *map(F.asc, tie)], "_place")
    starts = ranked.groupBy(F.col(group).alias("_group")).agg(F.min("_place").alias("_start"))
    return ranked.join(starts, ranked[group].eqNullSafe(F.col("_group"))).withColumn(name, F.col("_place") - F.col("_start") + 1).select(*df.columns, name)


def full_ranks_shared(df: DataFrame, by: str, name: str, group: str = "query_id") -> DataFrame:
    """``rank_shared`` for rows that all are wanted: as ``full_ranks``, and equal values take their smallest."""
    ranked = full_ranks(df, by, [], "_place", group)
    least = ranked.groupBy(F.col(group).alias("_group"), F.col(by).alias("_by")).agg(F.min("_place").alias(name))
    same = ranked[group].eqNullSafe(F.col("_group")) & ranked[by].eqNullSafe(F.col("_by"))
    return ranked.join(least, same).select(*df.columns, name)


def log_of(d: Column) -> Column:
    """log2 of a distance, as numpy has it: -Infinity at zero; null below."""
    return F.when(d > 0, F.log2(d)).when(d == 0, F.lit(float("-inf")))


def _with_logs(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({f"{m}_log2": log_of(F.col(f"{m}_dist")) for m in names})


def compare_metrics(dist: DataFrame, names: list[str]) -> DataFrame:
    """Rank by each metric (``<name>_dist``, ties by ``ref_id``) and log2 of its distance (-Infinity at zero, null below) side by side, for all rows."""
    out = dist
    for m in names:
        out = full_ranks(out, f"{m}_dist", ["ref_id"], f"{m}_rank")
    return _with_logs(out, names)


def compare_top(dist: DataFrame, names: list[str], most: int) -> DataFrame:
    """Rows of ``compare_metrics`` with a rank up to ``most`` by any metric, without ranking the others.

    Those rows are few a query; a row's rank by another metric is the number of rows before it, counted
    by partial sums. ``(query_id, ref_id)`` must be unique and distances not null.
    """
    columns = ["query_id", "ref_id", *(f"{m}_dist" for m in names)]
    best = [rank_first(dist.select(*columns), F.col(f"{m}_dist"), ["ref_id"], "_r").where(F.col("_r") <= most).drop("_r") for m in names]
    few = reduce(DataFrame.unionByName, best).distinct()
    mine = few.select(F.col("query_id"), *(F.col(c).alias(f"_own_{c}") for c in columns[1:]))
    before = lambda m: (F.col(f"{m}_dist") < F.col(f"_own_{m}_dist")) | (F.col(f"{m}_dist") == F.col(f"_own_{m}_dist")) & (F.col("ref_id") < F.col("_own_ref_id"))
    counted = dist.select(*columns).join(mine, "query_id").groupBy("query_id", *(f"_own_{c}" for c in columns[1:])).agg(*((F.count_if(before(m)) + 1).alias(f"{m}_rank") for m in names))
    return _with_logs(counted.withColumnsRenamed({f"_own_{c}": c for c in columns[1:]}), names)


def compare_ranks(dist: DataFrame) -> DataFrame:
    """``compare_metrics`` of cosine and Jaccard distance."""
    return compare_metrics(dist, ["cosine", "jaccard"])


def top_of(compared: DataFrame, ranks: list[int], names: list[str]) -> DataFrame:
    """Rows that hold one of ``ranks`` by any of the metrics."""
    return compared.where(reduce(lambda a, b: a | b, (F.col(f"{m}_rank").isin(ranks) for m in names)))


def top_of_any(compared: DataFrame, ranks: list[int]) -> DataFrame:
    """``top_of`` cosine and Jaccard distance."""
    return top_of(compared, ranks, ["cosine", "jaccard"])


def closest(dist: DataFrame, metric: str = "jaccard_dist") -> DataFrame:
    return dist.groupBy("query_id").agg(F.min(metric).alias("min_distance"))


def last_by_category(df: DataFrame, keys: list[str], category: str, order: list[str]) -> DataFrame:
    """Per key the row whose category comes last in ``order``; of several, the first by all columns."""
    place = F.coalesce(F.array_position(F.array(*map(F.lit, order)), F.col(category)), F.lit(0))
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(place.desc(), *df.columns))
    return df.withColumn("_n", n).where("_n = 1").drop("_n")
