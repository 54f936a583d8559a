"""Classifier metrics as aggregations and running sums over (label, score)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import safe_f1
from .ordered import ordered_sums, with_next


def confusion(df: DataFrame, label: str, predicted: Column) -> DataFrame:
    """tp, fp, fn, tn, precision, recall, f1 in one pass; zero denominators give zero."""
    y, p = F.col(label) == 1, predicted
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).alias("x")
    out = df.agg(count(y & p).alias("tp"), count(~y & p).alias("fp"), count(y & ~p).alias("fn"), count(~y & ~p).alias("tn"))
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(a) + F.col(b)), F.lit(0.0))
    out = out.withColumns({"precision": share("tp", "fp"), "recall": share("tp", "fn")})
    return out.withColumn("f1", F.coalesce(safe_f1(F.col("precision"), F.col("recall")), F.lit(0.0)))


def _by_score(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives of each distinct score: the table that running sums are taken over."""
    return df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(score).alias("threshold")).agg(
        F.sum((F.col(label) == 1).cast("long")).alias("pos"), F.sum((F.col(label) != 1).cast("long")).alias("neg")
    )


def auroc(df: DataFrame, label: str, score: str, parts: int | None = None) -> DataFrame:
    """Area under the ROC curve from average ranks; ties count half. Null with one class only.

    ``parts`` is the number of score ranges (default: shuffle partitions).
    """
    ranked = ordered_sums(_by_score(df, label, score), [F.asc("threshold")], {"below": F.col("neg")}, parts)
    won = F.col("pos") * (F.col("below") + F.col("neg") / 2)
    return ranked.agg(F.try_divide(F.sum(won), F.sum("pos").cast("double") * F.sum("neg")).alias("auroc"))


def pr_curve(df: DataFrame, label: str, score: str, legacy_alignment: bool = False, parts: int | None = None) -> DataFrame:
    """``threshold, precision, recall`` for each distinct score, in descending order, cut where recall reaches one,
    and the end point (null threshold, precision 1, recall 0).

    ``legacy_alignment`` moves each threshold one point towards lower scores and gives the
    lowest point an infinite one, as the data behind earlier published figures had.
    ``parts`` is the number of score ranges (default: shuffle partitions).
    """
    counts = ordered_sums(_by_score(df, label, score), [F.desc("threshold")], {"tp": F.col("pos"), "fp": F.col("neg")}, parts)
    total = counts.agg(F.sum("pos")).first()[0]
    counts = counts.where(F.col("tp") < F.lit(total)).withColumns({"tp": F.col("tp") + F.col("pos"), "fp": F.col("fp") + F.col("neg")})
    points = counts.select(
        F.col("threshold").cast("double").alias("threshold"), F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")).alias("precision"), F.try_divide(F.col("tp").cast("double"), F.lit(total)).alias("recall")
    )
    if legacy_alignment:
        points = with_next(points, [F.desc("threshold")], {"_lower": "threshold"}, parts)
        points = points.select(F.coalesce("_lower", F.lit(float("inf"))).alias("threshold"), "precision", "recall")
    end = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return points.union(end)


def pr_auc(curve: DataFrame, parts: int | None = None) -> DataFrame:
    """Area under a curve of ``pr_curve`` by trapezoids."""
    sides = with_next(curve, [F.desc("recall"), F.asc_nulls_last("threshold")], {"_recall": "recall", "_precision": "precision"}, parts)
    area = (F.col("recall") - F.col("_recall")) * (F.col("precision") + F.col("_precision")) / 2
    return sides.agg(F.sum(area).alias("pr_auc"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """The threshold of the highest F1; of equals the lowest."""
    scored = curve.where("threshold is not null").withColumn("f1", safe_f1(F.col("precision"), F.col("recall"))).where("f1 is not null")
    best = F.max_by(F.struct("threshold", "precision", "recall", "f1"), F.struct(F.col("f1"), -F.col("threshold")))
    return scored.agg(best.alias("b")).select("b.*")


def hard_threshold(curve: DataFrame, precision: float = 0.75) -> DataFrame:
    """The largest finite threshold at which precision is below a limit."""
    fits = (F.col("precision") < precision) & F.col("threshold").isNotNull() & (F.abs("threshold") < F.lit(float("inf")))
    return curve.agg(F.max(F.when(fits, F.col("threshold"))).alias("threshold"))


def agreement(df: DataFrame, actual: str, first: str, second: str) -> DataFrame:
    """TP, FP, FN or TN where two predictions agree; "Disagreement" else."""
    same = F.col(first) == F.col(second)
    kind = (
        F.when(same & (F.col(actual) == 1) & (F.col(first) == 1), "TP").when(same & (F.col(actual) == 0) & (F.col(first) == 1), "FP")
        .when(same & (F.col(actual) == 1) & (F.col(first) == 0), "FN").when(same & (F.col(actual) == 0) & (F.col(first) == 0), "TN")
    )
    return df.withColumn("agreement", F.coalesce(kind, F.lit("Disagreement")))


def counts_at_cut(df: DataFrame, actual: str, models: list[str], cut: float = 10) -> DataFrame:
    """``model, tp, fp, fn, tn``: each model (a column of counts) is positive from ``cut`` on; ``actual`` is 0 or 1. Null counts are left out."""
    long = df.select(F.col(actual).alias("_y"), *(F.col(m).cast("double").alias(m) for m in models)).unpivot(["_y"], models, "model", "_n").where("_n is not null")
    y, p = F.col("_y") == 1, F.col("_n") >= cut
    return long.groupBy("model").agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))


def best_experiment(df: DataFrame, keys: list[str], group: str, metric: str) -> DataFrame:
    """Mean metric by experiment, and within each group the best (ties kept)."""
    means = df.groupBy(*keys, group).agg(F.avg(metric).alias("mean_metric"))
    rank = F.rank().over(Window.partitionBy(group).orderBy(F.desc(F.round("mean_metric", 9))))
    return means.withColumn("_r", rank).where("_r = 1").drop("_r")
