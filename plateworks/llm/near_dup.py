"""MinHash near-dedup with an LSH forest.

A document's set holds the distinct 5-word shingles of its whole text. Each of ``ORDERS``
forest orders sorts all labels by other signature values; the neighbours with the longest
common prefix are candidates, however dense their region, and all pairs that share the first
``DEPTH`` values of an order and are not yet in one component are compared besides (see
``minhash``). At similarity 0.75 two documents share no such prefix in any order with
probability (1 - 0.75^3)^24 = 2e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import minhash, wordstream
from .common import components, filter_place, id_filter, in_filter, map_batches, materialize, prepare, tidy

ORDERS = 24
DEPTH = 3
PERCENT = 75


def _sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sets of a batch's texts, their offsets, and two 64-bit sums over each that name it (0 if empty)."""
    words = wordstream.Words(batch.column("text"))
    flat, offsets = wordstream.shingle_sets(words.hashes, words.first[:-1], words.first[1:], minhash.WIDTH)
    names = np.zeros((2, len(offsets) - 1), np.uint64)
    full = np.diff(offsets) > 0
    if full.any():
        names[0, full] = np.add.reduceat(flat, offsets[:-1][full])
        names[1, full] = np.add.reduceat(wordstream.mixed(flat + wordstream.STEP), offsets[:-1][full])
    first = wordstream.mixed(names[0] + np.diff(offsets).astype(np.uint64)).view(np.int64)
    return flat, offsets, first, names[1].view(np.int64)


def shingle_sets(documents: DataFrame, heads: DataFrame, ids: DataFrame) -> DataFrame:
    """``(id, shingles)``: sorted 64-bit shingle hashes of the classes in ``ids``.

    ``heads(id, name, second, doc_id)`` names a document of each class. A filter of the wanted documents keeps
    other texts unread; the join by name is exact, so that a document id that comes with two texts gives the right one."""
    wanted = heads.join(ids, "id", "left_semi")
    shared = documents.sparkSession.sparkContext.broadcast(id_filter(wanted, "doc_id"))

    def compute(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        batch = batch.filter(pa.array(in_filter(shared.value, batch.column("place").to_numpy())))
        flat, offsets, name, second = _sets(batch)
        yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(second), wordstream.binaries(flat, offsets)], names=["name", "second", "shingles"])

    read = documents.where("doc_id is not null").select("text", filter_place("doc_id").alias("place"))
    found = map_batches(read, compute, "name long, second long, shingles binary").join(wanted, ["name", "second"]).select("id", "shingles")
    return found.dropDuplicates(["id"])  # equal sets: any of them


def near_duplicates(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row a document: ``doc_id, n_shingles, component_id, kept``.

    Null and blank texts have an empty set, are linked with nothing and kept. Equal sets
    (told by 128 bits) are one class, whatever their number, so a large group of copies costs one row.
    A row without ``doc_id`` is its own: component null, kept. Rows that repeat a ``doc_id``
    are one vertex, with the links of all their texts. Only ``doc_id`` and ``text`` are read. An empty table gives no rows.
    """
    spark = prepare(documents.sparkSession)
    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def sketch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        flat, offsets, name, second = _sets(batch)
        columns = minhash.sketch_columns(flat, offsets, ORDERS, DEPTH)
        # Copies within the batch: only the first of them carries its labels.
        named = np.flatnonzero(batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False))
        old = np.ones(len(name), bool)
        old[named[np.unique(np.stack([name[named], second[named]]), axis=1, return_index=True)[1]]] = False
        take = pa.array(np.arange(len(name)), mask=old)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(name), pa.array(second), columns[0], *(c.take(take) for c in columns[1:])],
            names=["doc_id", "name", "second", "n", "keys", "rest", "sketch"],
        )

    sketched = materialize(map_batches(read, sketch, f"doc_id long, name long, second long, {minhash.SKETCHED}"), "near-sketch")
    key = ["name", "second"]
    named = sketched.where("n > 0 and doc_id is not null")
    labels = [F.any_value(c, F.lit(True)).alias(c) for c in ("keys", "rest", "sketch")]
    heads = named.groupBy(*key, "n").agg(F.min("doc_id").alias("doc_id"), *labels)
    # Written at once, so that the numbers stay as they are.
    classes = materialize(heads.withColumn("id", F.monotonically_increasing_id()), "near-classes")
    heads = classes.select("id", *key, "doc_id")
    found = minhash.linked_classes(classes.select("id", "n", "keys", "rest", "sketch"), lambda ids, bits: shingle_sets(read, heads, ids), DEPTH, percent, "near")
    # Classes that one document id holds are one vertex too.
    held = named.groupBy("doc_id").agg(F.min(F.struct(*key)).alias("a"), F.max(F.struct(*key)).alias("b")).where("a <> b")
    held = materialize(held.select("doc_id", "a"), "near-repeated-ids")
    if not held.isEmpty():
        both = named.select("doc_id", *key).distinct().join(held, "doc_id").join(heads.drop("doc_id"), key)
        first = heads.select(F.struct(*key).alias("a"), F.col("id").alias("one"))
        both = both.join(first, "a").select(F.col("one").alias("a"), F.col("id").alias("b"))
        linked = found.select(F.col("component").alias("a"), F.col("id").alias("b"))
        found = components(both.union(linked), "near-repeated")
    own = heads.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = own.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named_by = materialize(own.join(least, "component").select(*key, "component_id"), "near-components")
    tidy(spark)
    members = sketched.select("doc_id", "n", *key).join(named_by, key, "left")
    # A set without words is its own; so is a row without id.
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return members.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_first(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``documents`` with one document of each component, the one of the smallest id; columns unchanged.

    Rows without id, and blank texts, stay. Rows that repeat a kept id all stay.
    """
    # Written first, so that its size is known: a small table is broadcast and the texts are not shuffled.
    gone = materialize(near_duplicates(documents, percent).where("not kept").select(F.col("doc_id").alias("_gone")).distinct(), "near-gone")
    return documents.join(gone, documents["doc_id"] == gone["_gone"], "left_anti")


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near copies in all ``documents``."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(documents).select("doc_id", "n_shingles", "component_id", "kept")
