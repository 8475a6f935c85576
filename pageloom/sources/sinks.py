"""Writing results.  Each write is one action; what it reports is what was written."""

from __future__ import annotations

import json
import zipfile
from collections.abc import Callable, Iterable, Iterator
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import output_name
from ..operators.documents import as_json
from .files import bounded
from .objects import put

#: The name of the sheet, and the most rows that the format of workbooks has.
SHEET_NAME, SHEET_ROWS = "Opt-In Results", 1_048_576


def _reported(rows: DataFrame, folder: str) -> DataFrame:
    """Runs the writer behind rows once: its report is kept beside the results, as a table."""
    place = f"{folder.rstrip('/')}/_written"
    rows.write.mode("overwrite").parquet(place)
    return rows.sparkSession.read.schema(rows.schema).parquet(place)


def pretty(text: str) -> str:
    """JSON indented by two, with all but ASCII escaped."""
    return json.dumps(json.loads(text), indent=2, ensure_ascii=True)


def write_documents(docs: DataFrame, folder: str, kind: str = "text") -> DataFrame:
    """Writes each nested document as folder/<name of its source>.txt or .json; returns source_path, file_name and written.

    Where sources of several folders have one name, all but the first, by path, are numbered: none replaces another.
    """
    name = output_name(F.col("source_path"), kind)
    nth = F.row_number().over(Window.partitionBy("_name").orderBy("source_path"))
    extension = {"text": ".txt", "json": ".json"}[kind]
    names = docs.select("source_path", name.alias("_name")).withColumn("_n", nth)
    file_name = F.when(F.col("_n") == 1, F.col("_name")).otherwise(F.concat(F.expr(f"left(_name, length(_name) - {len(extension)})"), F.lit(" ("), F.col("_n").cast("string"), F.lit(f"){extension}")))
    body = as_json(docs).select("source_path", F.col("json").alias("value")) if kind == "json" else docs.select("source_path", F.col("combined_text").alias("value"))
    rows = bounded(body.join(names.select("source_path", file_name.alias("file_name")), "source_path"))

    def run(batches):
        for batch in batches:
            out = [put(folder, n, (pretty(v) if kind == "json" else v).encode()) for n, v in zip(batch["file_name"], batch["value"], strict=True)]
            yield batch[["source_path", "file_name"]].assign(written=out)

    return _reported(rows.mapInPandas(run, "source_path string, file_name string, written string"), folder)


def write_splits(manifest: DataFrame, contents: DataFrame, write: Callable[[str, str, bytes, list[int]], str], folder: str) -> DataFrame:
    """pdf_id, group_no, file_name, written: each document of the manifest written from its PDF's bytes (pdf_id, content).

    write(pdf_id, file_name, content, page_idxs) returns where it wrote; it runs on the executors, and may run again for
    a lost task, so it must overwrite.  A PDF's bytes are sent once, whatever the number of its documents.  folder: where
    the report is kept.
    """
    made = manifest.groupBy("pdf_id").agg(F.array_sort(F.collect_list(F.struct("group_no", "file_name", "page_idxs"))).alias("made"))

    def run(batches):
        import pandas as pd

        for batch in batches:
            rows = [(i, d["group_no"], d["file_name"], write(i, d["file_name"], c, list(map(int, d["page_idxs"])))) for i, c, ds in zip(batch["pdf_id"], batch["content"], batch["made"], strict=True) for d in ds]
            yield pd.DataFrame(rows, columns=["pdf_id", "group_no", "file_name", "written"])

    rows = bounded(contents.select("pdf_id", "content").join(made, "pdf_id"))
    return _reported(rows.mapInPandas(run, "pdf_id string, group_no int, file_name string, written string"), folder)


def _cells(values: Iterable[str], number: int, style: str = "") -> str:
    def cell(k: int, v: str) -> str:
        return f'<c r="{chr(65 + k)}{number}" t="inlineStr"{style}><is><t xml:space="preserve">{escape("".join(c for c in v if c >= " " or c in chr(9) + chr(10)))}</t></is></c>'

    return f'<row r="{number}">{"".join(cell(k, v) for k, v in enumerate(values))}</row>'


_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml"


def write_workbook(header: list[str], rows: Iterator[Iterable[str]], path: str, name: str = SHEET_NAME) -> int:
    """A workbook of one sheet of texts with a bold header, row by row; returns the number of rows behind the header."""
    n = 0
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", f'{_HEAD}<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{_TYPE}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{_TYPE}.worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="{_TYPE}.styles+xml"/></Types>')
        z.writestr("_rels/.rels", f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}"><sheets><sheet name="{escape(name)}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_OFFICE}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Type="{_OFFICE}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'{_HEAD}<styleSheet xmlns="{_MAIN}"><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf xfId="0"/><xf xfId="0" fontId="1" applyFont="1"/></cellXfs></styleSheet>')
        with z.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as f:
            f.write(f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>{_cells(header, 1, " s=" + chr(34) + "1" + chr(34))}'.encode())
            for n, row in enumerate(rows, start=1):
                if n >= SHEET_ROWS:
                    raise ValueError(f"a workbook holds {SHEET_ROWS - 1} rows; write these as CSV")
                f.write(_cells(row, n + 1).encode())
            f.write(b"</sheetData></worksheet>")
    return n


def write_sheet(sheet: DataFrame, path: str) -> int:
    """Writes the sheet, in place of what is there: a workbook on the driver's disk if path ends in .xlsx, whose rows pass
    through the driver one by one; else CSV with headers, which Spark writes, its files in order.  Nothing if it has no rows.  Returns their
    number."""
    if path.endswith(".xlsx"):
        rows = sheet.toLocalIterator()
        first = next(rows, None)
        if first is None:
            return 0

        def every() -> Iterator[tuple]:
            yield first
            yield from rows

        return write_workbook(sheet.columns, every(), path)
    kept = sheet.persist()
    try:
        n = kept.count()
        if n:
            kept.write.mode("overwrite").option("header", "true").csv(path)
        return n
    finally:
        kept.unpersist()
