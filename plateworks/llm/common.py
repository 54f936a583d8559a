"""Shared helpers: shared-folder tables, batched Arrow mapping, connected components."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows an Arrow batch carries to a Python worker. Long texts make rows wide, so
#: the default of 10,000 could hold more than a worker's memory.
ARROW_ROWS = 1000
#: And bytes, for batches of very long texts or large sets.
ARROW_BYTES = 4 << 20

_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Ship this package to executors once per application and bound Arrow batches."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="plateworks-")) / f"{package.name}.zip"
        with zipfile.ZipFile(target, "w") as bundle:
            for file in sorted(package.rglob("*.py")):
                bundle.write(file, str(file.relative_to(package.parent)))
        spark.sparkContext.addPyFile(str(target))
        _shipped.add(app)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, one of this machine is set if driver and executors are one process (tests);
    on a cluster that would lose tables, so there it is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = f"file://{tempfile.gettempdir()}/plateworks-checkpoints"
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/plateworks/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._plateworks_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by ``materialize`` that nothing reads any more."""
    path = getattr(df, "_plateworks_path", None)
    if path:
        discard_path(df.sparkSession, path)


def discard_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in the shared folder that nothing reads any more."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(conf).delete(where, True)


def tidy(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs: it does so when the driver collects their plans."""
    gc.collect()
    spark._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What a worker remembers while a task runs: functions that forget it.
MEMOS: list[Callable[[], object]] = []


def release() -> None:
    """Give freed memory back to the system: workers live on, idle ones too."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not on this system's C library
        pass


def leave() -> None:
    """To be called when a task ends: there are more workers than tasks, and each would keep what it remembers."""
    for forget in MEMOS:
        forget()
    release()


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | Iterable[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """Apply ``fn`` to each Arrow batch of ``df`` that has rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                if batch.num_rows:
                    out = fn(batch)
                    if isinstance(out, pa.RecordBatch):
                        yield out
                    else:
                        yield from out
        finally:
            leave()

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return [t if t is not None else "" for t in batch.column(column).to_pylist()]


def local_path(uri: str) -> str | None:
    """The local path of a file: URI or a plain path; None for other stores."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return uri if "://" not in uri else None


def open_store(uri: str):
    """(filesystem, path) of pyarrow for a shared folder named by a URI."""
    from pyarrow import fs

    path = local_path(uri)
    if path is not None:
        os.makedirs(path, exist_ok=True)
        return fs.LocalFileSystem(use_mmap=True), path
    return fs.FileSystem.from_uri(uri)


class Merger:
    """Union of ids by their smallest, in memory: for what one task holds."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (up := self.parent.get(root, root)) != root:
            root = up
        while (up := self.parent.get(x, x)) != root:
            self.parent[x] = root
            x = up
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def stars(self) -> pa.RecordBatch:
        """Each id that is not the smallest of its set, with that smallest one."""
        ids = list(self.parent)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([self.find(x) for x in ids], pa.int64())], names=["a", "b"])


def contract(edges: DataFrame) -> DataFrame:
    """Edges with the same components, and within each partition none that others imply."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = Merger()
        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                merger.join(a, b)
        yield merger.stars()

    return edges.mapInArrow(run, "a long, b long")


#: Links that one task merges in memory (some ten megabytes); more are merged in rounds.
TASK_LINKS = 500_000


def components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a long, b long)`` as ``(id, component)``, without the smallest ids.

    ``component`` is the smallest id reachable; ids that are the smallest of their component
    are left out. Up to ``TASK_LINKS`` edges are merged by one task. Else edges lead from
    larger to smaller ids; in each round every id takes its
    smallest neighbour as parent, its other neighbours are hooked to that parent, and it
    moves on to its parent's parent, so that the number of rounds grows with the logarithm
    of a component's diameter. Each round is written to the shared folder; only a boolean
    reaches the driver. An id with very many neighbours is a partially aggregated minimum
    and a join side that can be split. Null ends and self-links are ignored; an empty table gives an empty result.
    """
    edges = edges.where("a is not null and b is not null and a <> b")
    edges = edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("r"), F.lit(True).alias("moved"))
    edges = materialize(edges, f"{name}-edges")
    if edges.count() <= TASK_LINKS:
        merged = contract(edges.select(F.col("v").alias("a"), F.col("r").alias("b")).coalesce(1))
        return materialize(merged.select(F.col("a").alias("id"), F.col("b").alias("component")), f"{name}-merged")
    for _ in range(max_rounds):
        parents = edges.groupBy("v").agg(F.min("r").alias("p"))
        above = parents.select(F.col("v").alias("p"), F.col("p").alias("g"))
        jumped = parents.join(above, "p", "left").select("v", F.coalesce("g", "p").alias("r"), F.col("g").isNotNull().alias("moved"))
        hooks = edges.join(parents, "v").where("r <> p").select(F.col("r").alias("v"), F.col("p").alias("r"), F.lit(True).alias("moved"))
        nxt = materialize(jumped.union(hooks), f"{name}-edges")
        settled = nxt.where("moved").isEmpty()
        discard(edges)
        edges = nxt
        if settled:
            return edges.select(F.col("v").alias("id"), F.col("r").alias("component"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


#: Bits of the filter that ``id_filter`` makes: two megabytes, whatever the number of ids.
FILTER_BITS = 1 << 24


def filter_place(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)).cast("int")


def hashed_place(column: str) -> Column:
    """``filter_place`` for ids that are hashes already."""
    return F.pmod(F.col(column), F.lit(FILTER_BITS)).cast("int")


def in_filter(bits: bytes, places: np.ndarray) -> np.ndarray:
    return (np.frombuffer(bits, np.uint8)[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)


def no_filter() -> bytes:
    """The filter of no ids."""
    return bytes(FILTER_BITS // 8)


def id_filter(ids: DataFrame, column: str = "id", place: Callable[[str], Column] = filter_place) -> bytes:
    """A bitmap of ``FILTER_BITS`` bits of the hashed ids, as bytes: of fixed size, so safe to send to all executors."""
    at = place(column).cast("long") + 1  # positions count from one
    rows = ids.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in rows:
        begin = (row["bucket"] - 1) * 4096
        out[begin : begin + 4096] = np.frombuffer(row["bits"], np.uint8)
    return out.tobytes()
