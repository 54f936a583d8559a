"""Readers. Tables come back lazily; only trees, sheets and requests, which are small, are parsed on the driver."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Callable, Iterable
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fold_underscore

MOLECULES = "chem_id string, smiles string"


def _tsv(spark: SparkSession, path: str | list[str], nameless: bool = False) -> DataFrame:
    # Files whose header is not the first file's are an error, never read by position.
    return spark.read.option("sep", "\t").option("header", True).option("enforceSchema", nameless).csv(path)


def read_molecules(
    spark: SparkSession, source: str | DataFrame, smiles: str = "smiles", chem_id: str = "chem_id", valid: Callable[[Column], Column] | None = None, cast_id_first: bool = False
) -> DataFrame:
    """``chem_id, smiles`` from a TSV (plain or gzip) or a DataFrame; rows without either are dropped.

    A missing id is dropped too, not turned into text, unless ``cast_id_first``: then it is kept as "nan", as where
    ids become text before rows are dropped. ``valid`` is a predicate on structures.
    """
    df = source if isinstance(source, DataFrame) else _tsv(spark, source)
    key = F.col(f"`{chem_id}`").cast("string")
    out = df.select((F.coalesce(key, F.lit("nan")) if cast_id_first else key).alias("chem_id"), F.col(f"`{smiles}`").cast("string").alias("smiles")).na.drop()
    return out if valid is None else out.where(valid(F.col("smiles")))


def read_representation(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``chem_id, vector array<float>`` from a TSV whose first column, without name, is the id; files with other headers are an error.

    Rows without an id are rows like others, with a null id. The first lines are compared in a pass of their own.
    """
    lines = spark.read.text(path).where("value <> ''").select("value", F.col("_metadata.file_path").alias("file"), F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("at"))
    if lines.groupBy("file").agg(F.min_by("value", "at").alias("header")).select("header").distinct().limit(2).count() > 1:
        raise ValueError("files with different headers")
    df = _tsv(spark, path, nameless=True)
    first, *rest = df.columns
    return df.select(F.col(f"`{first}`").alias("chem_id"), F.array(*(F.col(f"`{c}`").cast("float") for c in rest)).alias("vector"))


def read_matrix(spark: SparkSession, path: str, key: str, value: str = "value") -> DataFrame:
    """A compounds-by-strains TSV as rows ``key, strain_name, value``."""
    df = _tsv(spark, path)
    columns = [c for c in df.columns if c != key]
    wide = df.select(key, *(F.col(f"`{c}`").cast("double").alias(c) for c in columns))
    return wide.unpivot([key], [F.col(f"`{c}`") for c in columns], "strain_name", value)


def read_plates(spark: SparkSession, path: str, time_format: str = "MM/dd/yyyy HH:mm:ss") -> DataFrame:
    """Plate files (``Time`` and a column a well) as rows ``file, organism, replicate, time, well, od``.

    File names are organism and replicate; one with three underscores has its first taken out.
    A file without a header is an error when it is read.
    """
    lines = spark.read.text(path).where("value <> ''").select(F.split("value", "\t").alias("cells"), F.col("_metadata.file_path").alias("_path"), F.element_at(F.split(F.col("_metadata.file_name"), "/"), -1).alias("_file"))
    # Every file by its own header, in any order of columns; a row a file.
    headers = lines.where(F.array_contains("cells", "Time")).select("_path", F.col("cells").alias("header"))
    rows = lines.where(~F.array_contains("cells", "Time")).join(headers, "_path", "left")
    absent = F.raise_error(F.concat(F.lit("no header with Time in "), F.col("_path"))).cast("array<string>")
    rows = rows.withColumn("header", F.when(F.col("header").isNull(), absent).otherwise(F.col("header")))
    at = F.get(F.col("cells"), (F.array_position("header", F.lit("Time")) - 1).cast("int"))
    cells = rows.select("_file", F.to_timestamp(at, time_format).alias("time"), F.explode(F.arrays_zip(F.col("header").alias("well"), F.col("cells").alias("od"))).alias("cell"))
    long = cells.select("_file", "time", "cell.well", F.nullif(F.col("cell.od"), F.lit("")).try_cast("double").alias("od")).where(F.col("well").rlike("^[A-H][0-9]{1,2}$"))
    name = fold_underscore(F.col("_file"))
    return long.select(
        name.alias("file"), F.regexp_extract(name, r"^(.*)_([^_]*)$", 1).alias("organism"), F.regexp_extract(name, r"_([^_]*)$", 1).alias("replicate"), "time", "well", "od"
    )


def molecules_from_request(spark: SparkSession, params: dict) -> DataFrame:
    """``ord, chem_id, smiles`` from a request: a list under "molecules", else one "smiles". Default ids are mol1, mol2, ..."""
    found = params.get("molecules") or ([{"smiles": params["smiles"], "chem_id": params.get("chem_id")}] if params.get("smiles") else None)
    if not found:
        raise ValueError("a request needs molecules or smiles")
    rows = [(k, m.get("chem_id") or f"mol{k + 1}", m.get("smiles")) for k, m in enumerate(found)]
    return spark.createDataFrame(rows, "ord long, chem_id string, smiles string")


def newick_tips(spark: SparkSession, text: str) -> DataFrame:
    """``tip, depth, parent, length`` of a Newick tree's leaves; quoted names may hold any character but quotes."""
    tokens = re.findall(r"'([^']*)'|([(),;])|:([-+0-9.eE]+)|([^\s(),:;']+)", text)
    stack: list[list[int]] = [[]]
    nodes: list[dict] = []
    last: int | None = None
    for quoted, mark, length, name in tokens:
        if mark == "(":
            stack.append([])
            last = None
        elif mark == ")":
            children = stack.pop()
            nodes.append({"name": None, "children": children, "length": None})
            last = len(nodes) - 1
            stack[-1].append(last)
        elif mark:
            last = None
        elif length:
            if last is not None:
                nodes[last]["length"] = float(length)
        elif last is not None and nodes[last]["children"]:
            nodes[last]["name"] = quoted or name
        else:
            nodes.append({"name": quoted or name, "children": [], "length": None})
            last = len(nodes) - 1
            stack[-1].append(last)
    rows: list[tuple] = []
    todo = [(n, 0, None) for n in stack[0]]
    while todo:
        n, depth, parent = todo.pop()
        node = nodes[n]
        if node["children"]:
            todo += [(c, depth + 1, node["name"]) for c in node["children"]]
        else:
            rows.append((node["name"], depth, parent, node["length"]))
    return spark.createDataFrame(sorted(rows, key=lambda r: r[0] or ""), "tip string, depth int, parent string, length double")


def _cells(data: bytes, shared: list[str], space: str) -> Iterable[dict[int, str]]:
    for row in ElementTree.fromstring(data).iter(f"{space}row"):
        out = {}
        for cell in row.iter(f"{space}c"):
            column = 0
            for c in re.match("[A-Z]+", cell.get("r", "A"))[0]:
                column = column * 26 + ord(c) - 64
            value = cell.find(f"{space}v")
            if cell.get("t") == "inlineStr":
                out[column - 1] = "".join(t.text or "" for t in cell.iter(f"{space}t"))
            elif value is not None and value.text is not None:
                out[column - 1] = shared[int(value.text)] if cell.get("t") == "s" else value.text
        yield out


def read_sheet(spark: SparkSession, path: str, sheet: str | int = 0, skip: Iterable[int] = ()) -> DataFrame:
    """A sheet of an xlsx workbook, all columns as text; ``skip`` names rows (from 0) to leave out before the header."""
    space = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    link = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
    with zipfile.ZipFile(path) as book:
        names = book.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in s.iter(f"{space}t")) for s in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{space}si")]
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        sheets = [(s.get("name"), targets[s.get(link)]) for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{space}sheet")]
        target = sheets[sheet][1] if isinstance(sheet, int) else dict(sheets)[sheet]
        rows = list(_cells(book.read("xl/" + target.removeprefix("/xl/")), shared, space))
    gone = set(skip)
    kept = [r for k, r in enumerate(rows) if k not in gone]
    header = kept[0] if kept else {}
    width = max(header, default=-1) + 1
    columns = [header.get(k) or f"_c{k}" for k in range(width)]
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.createDataFrame([tuple(r.get(k) for k in range(width)) for r in kept[1:]], schema)
