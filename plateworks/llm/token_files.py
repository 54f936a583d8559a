"""Token-id output: flat unsigned integer files with 64-bit document offsets.

Each shard is ``<name>.bin`` (the ids of its documents one after another, no header) and
``<name>.idx`` (n + 1 unsigned 64-bit offsets in ids, then n signed 64-bit document ids).
A manifest table lists the shards in order with their counts (``n_nulls`` documents at a shard's start have no id); a shard's base is the
prefix sum of the counts before it. Readers map the files into memory.
"""

from __future__ import annotations

import array
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens
from .common import leave, local_path, open_store, prepare, shared_path

MANIFEST = "shard int, file string, dtype string, n_docs long, n_nulls long, n_tokens long"
#: Text bytes that a shard holds, about, unless a number of shards is given.
SHARD_BYTES = 1 << 30


@dataclass(frozen=True)
class TokenFiles:
    """Where the files are: ``folder`` for shards, ``manifest`` for the shard table."""

    folder: str
    manifest: str


def write_token_files(
    documents: DataFrame, folder: str | None = None, tokenizer: str | None = None, end_id: int = 0, shards: int | None = None
) -> TokenFiles:
    """Encode every text and write ids in ascending ``doc_id`` order.

    Null text is empty (its document is the end id alone); null ``doc_id`` sorts first; rows of
    one id, and rows without, are in order of their text's hash, and may be in several shards;
    repeated rows are written as often as they come; an empty table writes an empty
    manifest. Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
    A retried task writes files of another name, and the manifest names only the files of
    the attempt that finished.
    """
    spark = prepare(documents.sparkSession)
    folder = folder or shared_path(spark, "token-files")
    tokenizer = tokenizer or tokens.default_tokenizer()
    if shards is None:  # enough for the input, whatever the session's number of partitions
        size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        code, kind = tokens.encoder(tokenizer), tokens.id_type(tokenizer)
        end = np.array([end_id], dtype="<u4").tobytes()
        shard = TaskContext.get().partitionId()
        name = f"{shard:06d}-{uuid.uuid4().hex}"
        ids, counts, nulls = array.array("q"), array.array("q"), array.array("q")
        try:
            with store.open_output_stream(f"{path}/{name}.bin") as out:
                for batch in batches:
                    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                        found = code.encode(text.as_py() or "") + end
                        if doc_id is None:
                            nulls.append(len(ids))
                        ids.append(doc_id or 0)
                        counts.append(len(found) // 4)
                        out.write(np.frombuffer(found, dtype="<u4").astype(kind).tobytes())
        finally:
            leave()
        offsets = np.zeros(len(counts) + 1, dtype="<u8")
        np.cumsum(np.frombuffer(counts, np.int64), out=offsets[1:])
        # Null ids sort first, so their number says which they are.
        assert list(nulls) == list(range(len(nulls)))
        with store.open_output_stream(f"{path}/{name}.idx") as out:
            out.write(offsets)
            out.write(np.frombuffer(ids, "<i8"))
        if len(ids):
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "file": [name], "dtype": [kind], "n_docs": [len(ids)], "n_nulls": [len(nulls)], "n_tokens": [int(offsets[-1])]}
            )

    manifest = f"{folder}/manifest"
    # Equal ids are told apart by their texts, and equal rows by where they stand, so that a range can end among them.
    order = [F.asc_nulls_first("doc_id"), F.asc("_hash"), F.asc("_row")]
    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    (
        read.select("*", F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_row"))
        .repartitionByRange(shards, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(write, MANIFEST)
        .write.parquet(manifest)
    )
    return TokenFiles(folder, manifest)


def shard_bases(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """The manifest with ``base``, the ids in all shards before. One row a shard, so the window is small."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = spark.read.schema(MANIFEST).parquet(files.manifest)
    return shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def map_ids(uri: str, kind: str) -> np.ndarray:
    """The ids of a .bin file, mapped into memory where the store is a local or mounted folder."""
    path = local_path(uri)
    if path is not None:
        return np.memmap(path, dtype=kind, mode="r")
    store, inside = open_store(uri)
    with store.open_input_file(inside) as file:
        return np.frombuffer(file.read(), dtype=kind)


def _map_index(uri: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = map_ids(uri, "<u8")
    return raw[: n + 1], raw[n + 1 :].view("<i8")


def read_token_files(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids_crc32, shard``, one task a shard."""
    folder = files.folder

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                offsets, ids = _map_index(f"{folder}/{row['file']}.idx", row["n_docs"])
                flat = map_ids(f"{folder}/{row['file']}.bin", row["dtype"])
                step = 4096
                for at in range(0, row["n_docs"], step):
                    o = offsets[at : at + step + 1].astype(np.int64)
                    part = np.ascontiguousarray(flat[o[0] : o[-1]], dtype="<u4")
                    view, o0 = memoryview(part).cast("B"), o[0]
                    crc = [zlib.crc32(view[4 * (a - o0) : 4 * (b - o0)]) for a, b in zip(o[:-1].tolist(), o[1:].tolist())]
                    doc = np.array(ids[at : at + step])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc, pa.int64(), mask=np.arange(at, at + len(doc)) < row["n_nulls"]),
                            pa.array(o[:-1] + row["base"], pa.int64()),
                            pa.array(np.diff(o), pa.int64()),
                            pa.array(crc, pa.int64()),
                            pa.array(np.full(len(doc), row["shard"]), pa.int32()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32", "shard"],
                    )

    spark = prepare(spark)
    shards = shard_bases(spark, files)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return shards.repartition(n).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all ``documents`` as token files, read them back, one row a document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_token_files(spark, write_token_files(documents))
