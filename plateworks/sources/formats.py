"""Spark data sources: folders of plate files to read, and shards with a manifest to write and read.

``register(spark)`` makes them known as ``plates`` and ``manifest``:

    spark.read.format("plates").load("/data/*_OD.tsv.gz").where("well = 'A1'")
    df.write.format("manifest").mode("append").save("/data/out")
    spark.read.format("manifest").load("/data/out")
"""

from __future__ import annotations

import glob
import io
import json
import os
import re
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

PLATES = "file string, organism string, replicate string, time timestamp, well string, od double"
_NAMED = ("file", "organism", "replicate")
_WELL = re.compile("[A-H][0-9]{1,2}")


def _store(uri: str):
    """(filesystem of pyarrow, path in it) of a path or URI."""
    from pyarrow import fs

    if "://" in uri and not uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/") if uri.startswith("file:") else os.path.abspath(uri)


def _matching(pattern: str) -> list[str]:
    """Files of a folder, or those that a pattern in the last part of a path matches."""
    from pyarrow import fs

    store, path = _store(pattern)
    folder, name = (path, "*") if not glob.has_magic(path) else os.path.split(path)
    if not glob.has_magic(path) and store.get_file_info(path).is_file:
        return [path]
    match = re.compile(glob.translate(name))
    return sorted(x.path for x in store.get_file_info(fs.FileSelector(folder)) if x.is_file and match.fullmatch(x.base_name))


def named(path: str, suffix: str = "_OD.tsv.gz") -> dict[str, str]:
    """``file``, ``organism`` and ``replicate`` from a plate file's name; of three underscores the first goes."""
    name = os.path.basename(path)
    if name.count("_") == 3:
        name = name.replace("_", "", 1)
    name = name.removesuffix(suffix)
    organism, mark, replicate = name.rpartition("_")
    return {"file": name, "organism": organism, "replicate": replicate if mark else ""}


@dataclass
class PlateFile(InputPartition):
    path: str
    wells: tuple[str, ...] | None

    def __init__(self, path: str, wells: tuple[str, ...] | None):
        self.path, self.wells = path, wells


class PlateReader(DataSourceReader):
    """A partition a file, each read by its own header; a file without one is an error."""

    def __init__(self, schema: StructType, options: dict[str, str]):
        self.columns = schema.fieldNames()
        unknown = set(self.columns) - {c.split()[0] for c in PLATES.split(", ")}
        if unknown:
            raise ValueError(f"plates have no column {sorted(unknown)[0]}")
        self.path, self.pattern = options["path"], options.get("timeFormat", "%m/%d/%Y %H:%M:%S")
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equalities on names drop files before any is opened, those on wells drop columns of the file."""
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if values is not None and len(f.attribute) == 1 and f.attribute[0] in (*_NAMED, "well"):
                column = f.attribute[0]
                self.wanted[column] = self.wanted.get(column, values) & values
            else:
                yield f

    def partitions(self) -> list[PlateFile]:
        wells = tuple(sorted(self.wanted["well"])) if "well" in self.wanted else None
        keep = lambda name: all(name[c] in self.wanted[c] for c in _NAMED if c in self.wanted)
        return [PlateFile(path, wells) for path in _matching(self.path) if keep(named(path))]

    def read(self, partition: PlateFile) -> Iterator[pa.RecordBatch]:
        store, path = _store(self.path)[0], partition.path
        name, header, rows = named(path), None, []
        with store.open_input_stream(path, compression="gzip" if path.endswith(".gz") else None) as raw:
            for line in io.TextIOWrapper(raw, encoding="utf-8"):
                cells = line.rstrip("\r\n").split("\t")
                if cells == [""]:
                    continue
                if header is None:
                    if "Time" not in cells:
                        raise ValueError(f"no header with Time in {path}")
                    header = cells
                    time = header.index("Time")
                    wells = [(k, w) for k, w in enumerate(header) if _WELL.fullmatch(w) and (partition.wells is None or w in partition.wells)]
                    continue
                rows.append(cells)
                if len(rows) == 1000:
                    yield self._batch(name, rows, time, wells)
                    rows = []
        if header is None:
            raise ValueError(f"no header with Time in {path}")
        if rows:
            yield self._batch(name, rows, time, wells)

    def _batch(self, name: dict[str, str], rows: list[list[str]], time: int, wells: list[tuple[int, str]]) -> pa.RecordBatch:
        n = len(rows) * len(wells)
        cell = lambda r, k: r[k] if k < len(r) else None
        made = {}
        for column in self.columns:  # only what the schema asks for is parsed
            if column in name:
                made[column] = pa.array([name[column]] * n, pa.string())
            elif column == "well":
                made[column] = pa.array([w for _ in rows for _, w in wells], pa.string())
            elif column == "time":
                parsed = pc.strptime(pa.array([cell(r, time) for r in rows], pa.string()), self.pattern, "us", error_is_null=True)
                at = [k for k in range(len(rows)) for _ in wells]
                made[column] = pc.assume_timezone(parsed, "UTC").take(pa.array(at, pa.int64()))
            else:
                made[column] = pa.array([_number(cell(r, k)) for r in rows for k, _ in wells], pa.float64())
        return pa.RecordBatch.from_pydict(made)


def _number(text: str | None) -> float | None:
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


class PlateSource(DataSource):
    """Plate files as rows ``file, organism, replicate, time, well, od``; a smaller schema reads only its columns.

    Options: ``path`` (a file, folder, or pattern in the last part), ``timeFormat``. Times are taken
    as UTC; those and values that cannot be read are null; empty lines are left out.
    """

    @classmethod
    def name(cls) -> str:
        return "plates"

    def schema(self) -> str:
        return PLATES

    def reader(self, schema: StructType) -> PlateReader:
        return PlateReader(schema, self.options)


# ---- shards with a manifest


@dataclass
class Shard(WriterCommitMessage):
    file: str
    rows: int


class ManifestWriter(DataSourceArrowWriter):
    """Executors write a Parquet file a task under a name of its own; the driver then lists those of the tasks that count.

    Files that no manifest lists (of failed or repeated tasks) are never read. The list is
    replaced in one step, so a reader sees all of a write or nothing of it.
    """

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, batches: Iterator[pa.RecordBatch]) -> Shard:
        import pyarrow.parquet as pq

        store, path = _store(self.path)
        store.create_dir(path, recursive=True)
        file, rows, out = f"shard-{uuid.uuid4().hex}.parquet", 0, None
        for batch in batches:
            out = out or pq.ParquetWriter(f"{path}/{file}", batch.schema, filesystem=store)
            out.write_batch(batch)
            rows += batch.num_rows
        if out is None:
            return Shard("", 0)
        out.close()
        return Shard(file, rows)

    def commit(self, messages: list[Shard | None]) -> None:
        store, path = _store(self.path)
        store.create_dir(path, recursive=True)
        before = read_manifest(self.path)
        new = [{"file": m.file, "rows": m.rows} for m in messages if m and m.file]
        fresh = f"{path}/.manifest-{uuid.uuid4().hex}"
        with store.open_output_stream(fresh) as out:
            out.write(json.dumps(new if self.overwrite else before + new, indent=1).encode())
        store.move(fresh, f"{path}/manifest.json")
        for shard in before if self.overwrite else []:
            store.delete_file(f"{path}/{shard['file']}")

    def abort(self, messages: list[Shard | None]) -> None:
        store, path = _store(self.path)
        for m in messages:
            if m and m.file and store.get_file_info(f"{path}/{m.file}").is_file:
                store.delete_file(f"{path}/{m.file}")


def read_manifest(path: str) -> list[dict]:
    """The shards that a folder's manifest lists; none without one."""
    store, inside = _store(path)
    if not store.get_file_info(f"{inside}/manifest.json").is_file:
        return []
    with store.open_input_stream(f"{inside}/manifest.json") as file:
        return json.loads(file.read())


@dataclass
class ShardFile(InputPartition):
    file: str

    def __init__(self, file: str):
        self.file = file


class ManifestReader(DataSourceReader):
    def __init__(self, schema: StructType, path: str):
        self.columns, self.path = schema.fieldNames(), path

    def partitions(self) -> list[ShardFile]:
        return [ShardFile(s["file"]) for s in read_manifest(self.path)]

    def read(self, partition: ShardFile) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        store, path = _store(self.path)
        yield from pq.ParquetFile(f"{path}/{partition.file}", filesystem=store).iter_batches(columns=self.columns)


class ManifestSource(DataSource):
    """Parquet shards with a manifest. A smaller schema reads only its columns; without one, that of the first shard is taken."""

    @classmethod
    def name(cls) -> str:
        return "manifest"

    def schema(self) -> StructType:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        shards = read_manifest(self.options["path"])
        if not shards:
            raise ValueError(f"no manifest with shards in {self.options['path']}")
        store, path = _store(self.options["path"])
        return from_arrow_schema(pq.read_schema(f"{path}/{shards[0]['file']}", filesystem=store))

    def reader(self, schema: StructType) -> ManifestReader:
        return ManifestReader(schema, self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> ManifestWriter:
        return ManifestWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    """Make both formats known, with filters pushed into them; their code goes to the executors with them."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PlateSource)
    spark.dataSource.register(ManifestSource)
