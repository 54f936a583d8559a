"""Packing: concatenate all documents and cut the stream into fixed windows.

Pass one encodes each input partition into chunks (consecutive documents with their ids)
and keeps every chunk's start within its partition. The prefix sum over partition token
totals then gives each partition's global base. Pass two cuts chunks at multiples of the
window. Windows that lie inside a chunk are whole at once; the two that cross a chunk's
ends are boundary records, which alone are shuffled to be joined.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens
from .common import leave, map_batches, materialize, prepare

WINDOW = 1024
#: Input partitions up to which their bases (16 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_PARTS = 500_000
CHUNKS = "part int, local_start long, n_tokens long, doc_ids array<long>, lengths array<long>, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def encode_chunks(documents: DataFrame, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """Pass one, written to the shared folder: chunks of encoded documents with global ``base``.

    Null text is empty (the end id alone), null ``doc_id`` stays null, repeated rows are
    packed as often as they come, an empty table gives no chunk. Other columns are not read.
    """
    spark = prepare(documents.sparkSession)
    tokenizer = tokenizer or tokens.default_tokenizer()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, kind = tokens.encoder(tokenizer), tokens.id_type(tokenizer)
        end = np.array([end_id], dtype="<u4").tobytes()
        part, at = TaskContext.get().partitionId(), 0
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                lengths, ids = [], io.BytesIO()
                for text in batch.column("text"):
                    found = code.encode(text.as_py() or "") + end
                    lengths.append(len(found) // 4)
                    ids.write(np.frombuffer(found, dtype="<u4").astype(kind).tobytes())
                n = sum(lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()),
                        pa.array([at], pa.int64()),
                        pa.array([n], pa.int64()),
                        pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                        pa.array([lengths], pa.list_(pa.int64())),
                        pa.array([ids.getvalue()], pa.binary()),
                    ],
                    names=["part", "local_start", "n_tokens", "doc_ids", "lengths", "ids"],
                )
                at += n
        finally:
            leave()

    read = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    chunks = materialize(read.mapInArrow(encode, CHUNKS), "packing-chunks")
    # One row of two numbers an input partition.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        chunks.groupBy("part").agg(F.sum("n_tokens").alias("total"))
        .select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_base"))
    )
    bases = materialize(bases, "packing-bases")
    if bases.count() <= BROADCAST_PARTS:
        bases = F.broadcast(bases)
    return chunks.join(bases, "part").withColumn("base", F.col("part_base") + F.col("local_start"))


def cut(chunks: DataFrame, tokenizer: str | None = None, window: int = WINDOW) -> DataFrame:
    """Pass two: the pieces of all documents, one row a piece, in ``PIECES`` columns."""
    kind = tokens.id_type(tokenizer or tokens.default_tokenizer())

    def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in batch.to_pylist():
            lengths = np.array(row["lengths"], dtype=np.int64)
            ids = np.frombuffer(row["ids"], dtype=kind).astype("<u4")
            view = memoryview(ids).cast("B")
            begins = row["base"] + np.concatenate([[0], np.cumsum(lengths)[:-1]])
            first, last = begins // window, (begins + lengths - 1) // window
            doc = np.repeat(np.arange(len(lengths)), last - first + 1)
            number = np.arange(len(doc)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1)
            sequence = first[doc] + number
            begin = np.maximum(begins[doc], sequence * window)
            finish = np.minimum(begins[doc] + lengths[doc], (sequence + 1) * window)
            inside = begin - row["base"]
            crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(inside.tolist(), (inside + finish - begin).tolist())]
            doc_ids = pa.array(row["doc_ids"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    doc_ids.take(pa.array(doc)),
                    pa.array(begin - begins[doc]),
                    pa.array(finish - begin),
                    pa.array(crc, pa.int64()),
                    pa.array(lengths[doc]),
                    pa.array(sequence),
                    pa.array(begin - sequence * window),
                ],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return map_batches(chunks.select("base", "doc_ids", "lengths", "ids"), pieces, PIECES)


def sequences(chunks: DataFrame, tokenizer: str | None = None, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """The packed sequences: ``sequence_id long, ids array<int>, n_tokens int``; the last is padded to ``window``."""
    kind = tokens.id_type(tokenizer or tokens.default_tokenizer())

    def windows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["ids"], dtype=kind).astype(np.int32)
            edges = np.unique(np.clip(np.arange(row["base"] // window, (row["base"] + len(ids)) // window + 2) * window - row["base"], 0, len(ids)))
            spans = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(row["base"] + a) // window for a, _ in spans], pa.int64()),
                    pa.array([(row["base"] + a) % window for a, _ in spans], pa.int32()),
                    pa.array([ids[a:b] for a, b in spans], pa.list_(pa.int32())),
                ],
                names=["sequence_id", "offset", "ids"],
            )

    cuts = map_batches(chunks.select("base", "ids"), windows, "sequence_id long, offset int, ids array<int>")
    whole = cuts.where(F.size("ids") == window).select("sequence_id", "ids")
    joined = (
        cuts.where(F.size("ids") < window)  # boundary records
        .groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
        .select("sequence_id", F.flatten("parts.ids").alias("ids"))
    )
    padded = F.concat("ids", F.array_repeat(F.lit(pad_id), F.greatest(F.lit(0), F.lit(window) - F.size("ids"))))
    return whole.union(joined).select("sequence_id", padded.alias("ids"), F.size("ids").alias("n_tokens"))


def pack(documents: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end_id: int = 0) -> DataFrame:
    """All pieces of ``documents`` (see ``cut``)."""
    return cut(encode_chunks(documents, tokenizer, end_id), tokenizer, window)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all ``documents`` into sequences of 1024 ids, one row a piece."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
