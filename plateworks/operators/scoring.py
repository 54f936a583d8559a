"""Pairs of compounds and strains, their scores, and each compound's potential."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import log_mean, none_if_nan, strain_number

# The published decision threshold and the number of strains that makes a spectrum broad.
THRESHOLD = 0.04374140128493309
BROAD_STRAINS = 10
#: A strain table of more rows is refused: it is sent whole to every executor.
STRAIN_LIMIT = 10_000


def pair_all(compounds: DataFrame, strains: DataFrame, limit: int = STRAIN_LIMIT) -> DataFrame:
    """Every compound with every strain. The strain table's size is checked, then it is broadcast."""
    if strains.limit(limit + 1).count() > limit:
        raise ValueError(f"more than {limit} strains")
    return compounds.crossJoin(F.broadcast(strains))


def score_pairs(pairs: DataFrame, scorer: Callable[[DataFrame], Column]) -> DataFrame:
    """``pairs`` with ``p`` from ``scorer``; NaN becomes null."""
    return pairs.withColumn("p", none_if_nan(scorer(pairs).cast("double")))


def logistic_scorer(vector: str, position: str, slope: float, intercept: float) -> Callable[[DataFrame], Column]:
    """Probability from one value of a vector; positions count from one."""

    def score(pairs: DataFrame) -> Column:
        x = F.element_at(pairs[vector], pairs[position].cast("int")).cast("double")
        return 1 / (1 + F.exp(-(slope * x + intercept)))

    return score


def table_scorer(scores: DataFrame, keys: list[str], value: str) -> Callable[[DataFrame], DataFrame]:
    """Probabilities looked up in a table of scores; pairs that it lacks get null."""
    table = scores.select(*keys, F.col(value).alias("p"))
    return lambda pairs: pairs.join(table, keys, "left")


def inhibited(p: Column, threshold: float = THRESHOLD) -> Column:
    """1 if ``p`` reaches the threshold, else 0; null counts as 0."""
    return F.coalesce((p >= threshold).cast("int"), F.lit(0))


def pair_id(compound: Column, strain: Column) -> Column:
    return F.concat(compound.cast("string"), F.lit(":"), strain)


def split_pair_id(df: DataFrame, column: str = "pred_id") -> DataFrame:
    """``chem_id``, ``strain_name``, ``nt_number`` from an id, split at its last colon."""
    c = F.col(column)
    strain = F.substring_index(c, ":", -1)
    return df.withColumns({"chem_id": F.expr(f"left({column}, length({column}) - length(substring_index({column}, ':', -1)) - 1)"), "strain_name": strain, "nt_number": strain_number(strain)})


def potential(scored: DataFrame, threshold: float = THRESHOLD, broad: int = BROAD_STRAINS) -> DataFrame:
    """Per compound: log-mean scores and inhibited strains, in all and by Gram stain, and the broad-spectrum flag.

    One aggregation. A compound without strains of a stain has null there; strains of
    unknown stain count in the totals only; equal compound ids are one compound.
    """
    hit = inhibited(F.col("p"), threshold)
    neg, pos = F.col("gram_stain") == "negative", F.col("gram_stain") == "positive"
    total = F.sum(hit)
    return scored.groupBy("chem_id").agg(
        log_mean(F.col("p")).alias("apscore_total"),
        log_mean(F.col("p"), neg).alias("apscore_gnegative"),
        log_mean(F.col("p"), pos).alias("apscore_gpositive"),
        total.alias("ginhib_total"),
        F.sum(F.when(neg, hit)).alias("ginhib_gnegative"),
        F.sum(F.when(pos, hit)).alias("ginhib_gpositive"),
        (total >= broad).cast("int").alias("broad_spectrum"),
    )


def potential_pivot(scored: DataFrame) -> DataFrame:
    """Log-mean scores by stain as columns, by an explicit pivot."""
    out = scored.groupBy("chem_id").pivot("gram_stain", ["negative", "positive"]).agg(F.avg(F.ln("p")))
    return out.select("chem_id", F.col("negative").alias("apscore_gnegative"), F.col("positive").alias("apscore_gpositive"))
