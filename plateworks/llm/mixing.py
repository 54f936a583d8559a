"""Mixing sources to target weights by iterative proportional fitting.

Token weights are summed by cell (source, language, topic); the query and the pipeline count
the real tokens of every text by one encoding pass (``measure``). Raking scales the cells until
their sums meet the target share of every category of the three marginals, with no cell
scaled above one (a document cannot be taken more than once). Where that bound keeps the
targets from being met, the kept share of all tokens is lowered until they are. A document's probability is
its cell's scale. Documents are then sampled by a keyed hash of their id, so that a retried
task, or another run, takes the same ones.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from . import tokens as tokenizers
from .common import map_batches, materialize, prepare, texts_of

OTHER = "other"
#: Share of all tokens that the mix takes at most, and target shares of the registered query.
KEEP = 0.7
TARGETS: dict[str, dict[str, float]] = {
    "source": {"src0": 0.25} | {f"src{k}": 0.75 / 19 for k in range(1, 20)},
    "lang": {"en": 0.47, "de": 0.20, "fr": 0.20, "es": 0.13},
    "topic": {"long": 0.42, "prose": 0.58},  # the rest keeps its share
}
ROUNDS = 500
CLOSE = 1e-9
#: The largest difference of a category's share of the mix from its target that counts as met.
TOLERANCE = 0.002
#: Halvings of the interval in which the kept share is sought, and the least share tried.
HALVINGS, LEAST_KEEP = 12, 0.01


def tokens_of(text: Column) -> Column:
    """Blanks and line feeds plus one: a native estimate of a text's tokens. Null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    rest = F.replace(F.replace(t, F.lit(" "), F.lit("")), F.lit("\n"), F.lit(""))
    return F.length(t) - F.length(rest) + 1


def topic_of(text: Column) -> Column:
    """A topic by form, where a table has none: "short", "lines" (short lines), "long" or "prose"."""
    t = F.coalesce(text, F.lit(""))
    lines = F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1
    return F.when(F.length(t) < 300, "short").when(F.length(t) < 80 * lines, "lines").when(F.length(t) > 6000, "long").otherwise("prose")


def _category(column: Column, named: Mapping[str, float]) -> Column:
    return F.when(column.cast("string").isin(list(named)), column.cast("string")).otherwise(OTHER)


def _cell_of(documents: DataFrame, targets: Mapping[str, Mapping[str, float]], topic: Column) -> Column:
    kinds = [_category(documents[c], targets[c]) for c in ("source", "lang")]
    kinds.append(_category(topic, targets["topic"]))
    return F.struct(*(k.alias(n) for k, n in zip(kinds, ("source", "lang", "topic"))))


def measure(documents: DataFrame, tokenizer: str | None = None, topic: Column | None = None) -> DataFrame:
    """``doc_id, source, lang, topic, text, n_tokens`` with the real token counts of all texts, written once.

    ``text`` stays only where there is no ``doc_id``, as such a document is drawn by it. Null
    and empty texts weigh one token.
    """
    prepare(documents.sparkSession)
    tokenizer = tokenizer or tokenizers.default_tokenizer()
    by_text = F.col("doc_id").isNull().alias("_by_text")
    read = documents.select(
        "doc_id",
        *(F.col(c).cast("string").alias(c) for c in ("source", "lang")),
        (topic if topic is not None else topic_of(documents["text"])).alias("topic"),
        F.col("text").cast("string").alias("text"),
        by_text,
    )

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        code = tokenizers.encoder(tokenizer)
        n = [max(1, len(code.encode(t)) // 4) for t in texts_of(batch)]
        kept = [t if wanted else None for t, wanted in zip(batch.column("text").to_pylist(), batch.column("_by_text").to_pylist())]
        columns = [batch.column(c) for c in ("doc_id", "source", "lang", "topic")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.string()), pa.array(n, pa.int64())], names=["doc_id", "source", "lang", "topic", "text", "n_tokens"])

    schema = StructType(read.schema.fields[:-1]).add("n_tokens", LongType())
    return materialize(map_batches(read, count, schema), "mixing-counts")


def rake(weights: np.ndarray, targets: list[np.ndarray]) -> np.ndarray:
    """Scales of the cells of ``weights`` in [0, 1] whose weighted sums meet the ``targets`` of each axis.

    A category whose target is NaN is left free. Where the upper bound makes the targets
    unreachable, the nearest that scaling finds is returned (see ``missed``).
    """
    scale = np.full(weights.shape, 1.0)
    for _ in range(ROUNDS):
        before = scale.copy()
        for axis, target in enumerate(targets):
            sums = (weights * scale).sum(axis=tuple(k for k in range(weights.ndim) if k != axis))
            factor = np.divide(target, sums, out=np.ones_like(sums), where=(sums > 0) & ~np.isnan(target))
            shape = [-1 if k == axis else 1 for k in range(weights.ndim)]
            scale = np.minimum(1.0, scale * factor.reshape(shape))
        if np.abs(scale - before).max() < CLOSE:
            break
    return scale


def missed(weights: np.ndarray, scale: np.ndarray, shares: list[np.ndarray]) -> float:
    """The largest difference of a category's share of the mix from its target share."""
    total = (weights * scale).sum()
    if not total:
        return 0.0
    sums = [(weights * scale).sum(axis=tuple(k for k in range(weights.ndim) if k != axis)) / total for axis in range(weights.ndim)]
    return max(float(np.nanmax(np.abs(s - t))) for s, t in zip(sums, shares))


@dataclass(frozen=True)
class Calibration:
    """The sampling probability of each cell, the share of all tokens kept, and what is missed of the targets."""

    chances: dict[tuple[str, str, str], float]
    keep: float
    residual: float


def calibrate(
    cells: Mapping[tuple[str, str, str], float], targets: Mapping[str, Mapping[str, float]], keep: float, tolerance: float = TOLERANCE, strict: bool = False
) -> Calibration:
    """Probabilities that meet ``targets`` to ``tolerance`` and keep up to ``keep`` of all tokens.

    Categories without a target ("other") keep their share; a named category without tokens
    gives its share to the others of its axis. If no kept share meets the targets (cells that
    are empty can rule it out), the nearest result is used with a warning, or an error if ``strict``.
    """
    names = [[*named, OTHER] for named in targets.values()]
    weights = np.zeros([len(n) for n in names])
    for cell, tokens in cells.items():
        weights[tuple(n.index(c) for n, c in zip(names, cell))] += tokens
    total = weights.sum()
    shares = []
    for axis, named in enumerate(targets.values()):
        sums = weights.sum(axis=tuple(k for k in range(weights.ndim) if k != axis))
        free = sums[-1] / total if total else 0.0
        share = np.array([*named.values()]) * (sums[:-1] > 0)
        shares.append(np.append(share / max(share.sum(), 1e-300) * (1 - free), free))

    def fitted(part: float) -> tuple[float, np.ndarray]:
        scale = rake(weights, [s * part * total for s in shares])
        return missed(weights, scale, shares), scale

    residual, scale = fitted(keep)
    if residual > tolerance:
        low, high = min(LEAST_KEEP, keep), keep
        best, best_scale = fitted(low)
        if best <= tolerance:
            residual, scale, keep = best, best_scale, low
            for _ in range(HALVINGS):
                part = (low + high) / 2
                found, tried = fitted(part)
                if found <= tolerance:
                    low, keep, residual, scale = part, part, found, tried
                else:
                    high = part
        elif strict:
            raise ValueError(f"targets are missed by {min(best, residual):.4f} of the tokens")
        else:
            warnings.warn(f"targets are missed by {residual:.4f} of the tokens", stacklevel=2)
    chances = {cell: float(scale[tuple(n.index(c) for n, c in zip(names, cell))]) for cell in cells}
    return Calibration(chances, keep, residual)


def mix(
    documents: DataFrame,
    targets: Mapping[str, Mapping[str, float]] = TARGETS,
    keep: float = KEEP,
    seed: int = 17,
    topic: Column | None = None,
    tokens: Column | None = None,
    measured: DataFrame | None = None,
    prefix: str = "_",
    strict: bool = False,
) -> DataFrame:
    """``documents`` with ``_tokens``, ``_cell`` (source, lang, topic), ``_probability``, ``_taken`` and
    ``_residual`` (what the calibration misses of a target share at most); ``prefix`` replaces the underscore.

    Columns of these names are overwritten. Documents weigh ``tokens``, or by default the estimate ``tokens_of``; with ``measured``
    (see ``measure``) the cells have the sums of its real counts, whatever ``_tokens`` says.
    The cells are at most the product of the named categories (each with "other"), a bound
    that the targets set and the data cannot raise; only they reach the driver. Null and
    unnamed categories are "other"; null and empty texts weigh one token; repeated ids share
    their fate; a document without id is drawn by its text. An empty table stays empty.
    """
    spark = prepare(documents.sparkSession)
    name = {k: f"{prefix}{k}" for k in ("tokens", "cell", "probability", "taken", "residual")}
    cell = _cell_of(documents, targets, topic if topic is not None else topic_of(documents["text"]))
    weight = tokens if tokens is not None else tokens_of(documents["text"])
    marked = documents.withColumns({name["tokens"]: weight.cast("long"), name["cell"]: cell}).drop(name["probability"], name["taken"], name["residual"])
    weighed = marked.select(F.col(name["cell"]).alias("cell"), F.col(name["tokens"]).alias("n"))
    if measured is not None:
        weighed = measured.select(_cell_of(measured, targets, measured["topic"]).alias("cell"), F.col("n_tokens").alias("n"))
    sums = weighed.groupBy("cell").agg(F.sum("n").alias("n")).collect()
    found = calibrate({tuple(r["cell"]): float(r["n"]) for r in sums}, targets, keep, strict=strict)
    rows = [(source, lang, kind, p, found.residual) for (source, lang, kind), p in sorted(found.chances.items())]
    of = f"{prefix}of"
    kinds = pa.schema([("source", pa.string()), ("lang", pa.string()), ("topic", pa.string()), ("probability", pa.float64()), ("residual", pa.float64())])
    # A local table, whose size the planner knows: it is broadcast if it is small.
    table = spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [()] * 5, kinds)], schema=kinds))
    table = table.select(F.struct("source", "lang", "topic").alias(of), F.col("probability").alias(name["probability"]), F.col("residual").alias(name["residual"]))
    drawn = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed), F.coalesce("text", F.lit("")))).otherwise(F.xxhash64(F.lit(seed), F.col("doc_id").cast("long")))
    even = F.shiftrightunsigned(drawn, 11) / F.lit(float(1 << 53))
    joined = marked.join(table, marked[name["cell"]] == table[of], "left").drop(of)
    return joined.withColumn(name["probability"], F.coalesce(name["probability"], F.lit(0.0))).withColumn(name["taken"], even < F.col(name["probability"]))


def sample(documents: DataFrame, targets: Mapping[str, Mapping[str, float]] = TARGETS, keep: float = KEEP, seed: int = 17) -> DataFrame:
    """The documents that the mix takes, by real token counts; columns unchanged, whatever their names."""
    prefix = "_mix_"
    while any(c.startswith(prefix) for c in documents.columns):
        prefix = f"_{prefix}"
    done = mix(documents, targets, keep, seed, measured=measure(documents), prefix=prefix)
    return done.where(F.col(f"{prefix}taken")).select(*(F.col(f"`{c}`") for c in documents.columns))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all ``documents``: each with its real token count, its probability and whether it is taken."""
    counts = measure(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mix(counts, topic=counts["topic"], tokens=counts["n_tokens"]).select(
        "doc_id",
        F.col("_cell.source").alias("source"),
        F.col("_cell.lang").alias("lang"),
        F.col("_cell.topic").alias("topic"),
        F.col("_tokens").alias("n_tokens"),
        F.col("_probability").alias("probability"),
        F.col("_taken").alias("taken"),
        F.col("_residual").alias("residual"),
    )
