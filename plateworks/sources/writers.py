"""Writers: single TSV files, appended and sharded output, sheets, JSON records, event streams."""

from __future__ import annotations

import gzip
import json
import os
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame


def _line(values: list) -> str:
    return "\t".join("" if v is None else str(v) for v in values) + "\n"


def write_tsv(df: DataFrame, path: str, header: bool = True) -> None:
    """One TSV file on the driver's file system (gzip if it ends in .gz), for results of report size.

    Rows come to the driver a partition at a time, so executors need not see ``path``.
    """
    with gzip.open(path, "wt") if path.endswith(".gz") else open(path, "w") as out:
        if header:
            out.write(_line(df.columns))
        for row in df.toLocalIterator():
            out.write(_line(list(row)))


def append_tsv(df: DataFrame, path: str) -> None:
    """Rows added to a TSV; the header is written only with the first."""
    fresh = not os.path.exists(path)
    with open(path, "a") as out:
        if fresh:
            out.write(_line(df.columns))
        for row in df.toLocalIterator():
            out.write(_line(list(row)))


def write_shards(df: DataFrame, path: str, order: str, shards: int) -> None:
    """Parquet in ``shards`` ranges of ``order``."""
    df.repartitionByRange(shards, order).write.mode("overwrite").parquet(path)


def write_sheets(frames: dict[str, DataFrame], path: str) -> None:
    """A workbook with a sheet for each frame, for results of report size."""
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    cell = lambda v: "<c/>" if v is None else f'<c t="n"><v>{v}</v></c>' if isinstance(v, (int, float)) and not isinstance(v, bool) else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'
    letters = lambda k: (letters(k // 26 - 1) if k >= 26 else "") + chr(65 + k % 26)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(1, len(frames) + 1))
        book.writestr("[Content_Types].xml", f'{head}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>')
        book.writestr("_rels/.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        book.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{escape(n)}" sheetId="{k}" r:id="r{k}"/>' for k, n in enumerate(frames, 1)) + "</sheets></workbook>")
        book.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{k}" Type="{rel}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(frames) + 1)) + "</Relationships>")
        for k, df in enumerate(frames.values(), 1):
            rows = [df.columns, *df.toLocalIterator()]
            body = "".join(f'<row r="{n}">' + "".join(cell(v).replace("<c", f'<c r="{letters(c)}{n}"', 1) for c, v in enumerate(row)) + "</row>" for n, row in enumerate(rows, 1))
            book.writestr(f"xl/worksheets/sheet{k}.xml", f'{head}<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')


def records(df: DataFrame) -> list[dict]:
    """Rows as dictionaries, for responses."""
    return [r.asDict(recursive=True) for r in df.toLocalIterator()]


def events(request_id: str, result: Iterator[dict] | None = None, error: str | None = None) -> Iterator[str]:
    """A response as server-sent events: start, data, end, or error."""
    frame = lambda kind, body: f"event: {kind}\ndata: {json.dumps(body, ensure_ascii=False)}\n\n"
    if error is not None:
        yield frame("error", {"id": request_id, "error": {"message": error}})
        return
    yield frame("start", {"id": request_id})
    yield frame("data", {"id": request_id, "result": list(result or [])})
    yield frame("end", {"id": request_id})


def write_csv(df: DataFrame, path: str) -> None:
    """Comma-separated files with a header."""
    df.write.option("header", True).mode("overwrite").csv(path)


def markdown(df: DataFrame, rows: int = 50) -> str:
    """The first ``rows`` rows as a Markdown table, for reports."""
    found = df.limit(rows).collect()
    lines = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in found])
