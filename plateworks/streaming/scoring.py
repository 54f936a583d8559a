"""Streams of compounds: stateless scoring in append mode, potentials and windowed counts with watermarks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import scoring


def score_stream(compounds: DataFrame, strains: DataFrame, scorer: Callable[[DataFrame], Column], threshold: float = scoring.THRESHOLD) -> DataFrame:
    """Pairs, probabilities and flags for a stream of compounds against a static strain table. Stateless."""
    scored = scoring.score_pairs(scoring.pair_all(compounds, strains), scorer)
    return scored.withColumn("growth_inhibition", scoring.inhibited(F.col("p"), threshold))


def potential_stream(scored: DataFrame) -> DataFrame:
    """Potentials by compound; for update or complete output."""
    return scoring.potential(scored)


def windowed_counts(events: DataFrame, time: str, keys: list[str], width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by window and key; state is dropped once the watermark has passed a window."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n")).select("window.start", "window.end", *keys, "n")
