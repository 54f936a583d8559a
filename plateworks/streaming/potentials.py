"""Running potentials of compounds on a stream of scored pairs, kept as state of each compound.

The state is what the potential is made of: counts, sums of logarithms and hits, in all and by
Gram stain, so it is of fixed size and any order of rows gives the batch result. A compound
without new rows for a time is dropped, by a timer, after a last row that says so.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import scoring

#: Per stain (all, negative, positive): rows with a score, sum of logarithms, zeros, hits, rows.
STATE = ", ".join(f"{k}_{s} {t}" for s in ("total", "gnegative", "gpositive") for k, t in (("n", "long"), ("logs", "double"), ("zeros", "long"), ("hits", "long"), ("rows", "long")))
OUTPUT = (
    "chem_id string, apscore_total double, apscore_gnegative double, apscore_gpositive double, ginhib_total long, ginhib_gnegative long, ginhib_gpositive long, broad_spectrum int, n_rows long, expired boolean"
)


class RunningPotential(StatefulProcessor):
    """One compound's state, its row after every batch that touches it, and its end after ``idle_ms`` without rows (0: never)."""

    def __init__(self, threshold: float = scoring.THRESHOLD, broad: int = scoring.BROAD_STRAINS, idle_ms: int = 0):
        self.threshold, self.broad, self.idle_ms = threshold, broad, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = list(self.sums.get()) if self.sums.exists() else [0, 0.0, 0, 0, 0] * 3
        for frame in rows:
            p = frame["p"].astype(float)
            for k, chosen in enumerate((slice(None), (frame["gram_stain"] == "negative").to_numpy(), (frame["gram_stain"] == "positive").to_numpy())):
                own = p[chosen]
                known = own[own.notna()]
                held[5 * k] += len(known)
                held[5 * k + 1] += float(known[known > 0].map(math.log).sum())
                held[5 * k + 2] += int((known <= 0).sum())
                held[5 * k + 3] += int((known >= self.threshold).sum())
                held[5 * k + 4] += len(own)
        self.sums.update(tuple(held))
        if self.idle_ms:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield self._row(key, held, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = list(self.sums.get())
        self.sums.clear()
        yield self._row(key, held, True)

    def _row(self, key, held: list, expired: bool) -> pd.DataFrame:
        score, hits = [], []
        for k in range(3):
            n, logs, zeros, hit, rows = held[5 * k : 5 * k + 5]
            score.append(float("-inf") if zeros else logs / n if n else None)
            hits.append(hit if rows else None)
        names = [c.split()[0] for c in OUTPUT.split(", ")]
        row = pd.DataFrame([[key[0], *score, *hits, int(held[3] >= self.broad), held[4], expired]], columns=names)
        return row.astype({c: "Int64" for c in names if c.startswith("ginhib")} | {c: float for c in names if c.startswith("apscore")})

    def close(self) -> None:
        pass


def running_potentials(scored: DataFrame, threshold: float = scoring.THRESHOLD, broad: int = scoring.BROAD_STRAINS, idle_ms: int = 0) -> DataFrame:
    """For a stream of ``chem_id, gram_stain, p``: a row for each compound that a batch touches, with its potential so far.

    Rows are as those of ``scoring.potential``, with ``n_rows`` so far and ``expired``. Null ids are one compound;
    null scores count as rows without a hit; a score of zero makes a mean minus infinity.
    For update mode; the state store has to be RocksDB.
    """
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    slim = scored.select(F.col("chem_id").cast("string").alias("chem_id"), F.col("gram_stain").cast("string").alias("gram_stain"), F.col("p").cast("double").alias("p"))
    return slim.groupBy("chem_id").transformWithStateInPandas(RunningPotential(threshold, broad, idle_ms), outputStructType=OUTPUT, outputMode="Update", timeMode="ProcessingTime" if idle_ms else "None")


def latest_by_batch(path: str):
    """A ``foreachBatch`` function: a batch's rows go to a folder of their own, which a repeated batch replaces whole."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return write


def latest(rows: DataFrame, key: str = "chem_id") -> DataFrame:
    """Of the rows written by ``latest_by_batch``, each compound's last."""
    best = rows.groupBy(key).agg(F.max_by(F.struct(*(c for c in rows.columns if c not in (key, "batch"))), "batch").alias("row"))
    return best.select(key, "row.*")
