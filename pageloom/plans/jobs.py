"""Whole jobs: extract, split, read forms.  Each takes what it can't do itself as a function."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as p
from ..functions.text import blob_target
from ..operators import documents, forms, grouping, legacy, signals
from ..sources import backends, files, ocr, sinks

Parse = Callable[[bytes], Iterator[tuple[int, str]]]


def result_name(stamp: str | None = None) -> str:
    """The name of a sheet of results, by the time of day unless stamp says it."""
    import datetime

    return f"opt_in_results_{stamp or datetime.datetime.now().strftime('%Y%m%d_%H%M%S')}"


def extract(spark: SparkSession, path: str, folder: str, kind: str = "text", recursive: bool = False, parse: Parse = backends.parse_pdf) -> DataFrame:
    """Writes the text of each PDF at path to folder, as text or JSON; returns source_path and file_name."""
    if files.discover(spark, path, recursive).isEmpty():
        raise ValueError(f"there is no PDF at {path}")
    pages = files.read_pages(files.contents(spark, path, recursive), parse)
    return sinks.write_documents(documents.nested(pages), folder, kind)


def ocr_reader(reader=backends.ocr_reader, raster=backends.raster):
    """What split() reads scanned pages with: their rasters drawn, and the strips of them read, on the executors."""

    def read(pages: DataFrame, strip: str) -> DataFrame:
        return ocr.read_strips(pages, strip, reader)

    read.raster = raster
    return read


def page_signals(pages: DataFrame, read_strip=None) -> DataFrame:
    """Signals of all pages: by their text, or by OCR where there is none.  Without read_strip, images say nothing."""
    digital, images = signals.route(pages)
    kept = ["pdf_id", "page_idx", "classification", "title_text", "page_num_in_doc", "total_pages_in_doc"]
    told = signals.with_text_signals(digital).select(*kept)
    if read_strip is None:
        seen = images.withColumn("s", signals._signal(signals.UNSURE))
    else:
        seen = signals.ocr_stages(images, read_strip).withColumn("s", signals.image_page_signal(F.lit(True), F.col("bottom"), F.col("top")))
    return told.unionByName(seen.select("pdf_id", "page_idx", "s.*"))


def split(spark: SparkSession, paths: list[str] | str, write, parse: Parse = backends.parse_pdf, read_strip=None, folder: str = "output/split") -> DataFrame:
    """Splits PDFs: pdf_id, group_no, file_name, blob (where the document goes under its PDF's name), written (what write returned)."""
    contents = spark.read.format("binaryFile").load(paths).select("path", "content")
    made = grouping.manifest(page_signals(_pages(contents, parse, read_strip), read_strip))
    out = sinks.write_splits(made, contents.withColumnRenamed("path", "pdf_id"), write, folder)
    return out.withColumn("blob", blob_target(F.col("pdf_id"), F.col("file_name")))


def _pages(contents: DataFrame, parse: Parse, read_strip) -> DataFrame:
    """The pages of PDFs; with a raster of each that has next to no text, if the reader draws them."""
    pages, raster = files.read_pages(contents, parse), getattr(read_strip, "raster", None)
    if raster is None:
        return pages
    _, images = signals.route(pages)
    wanted = images.groupBy("pdf_id").agg(F.sort_array(F.collect_list("page_idx")).alias("pages"))
    return pages.join(ocr.rasters(contents.withColumnRenamed("path", "pdf_id").join(wanted, "pdf_id"), raster), ["pdf_id", "page_idx"], "left")


def split_by_markers(spark: SparkSession, paths: list[str] | str, write, parse: Parse = backends.parse_pdf, folder: str = "output/split") -> DataFrame:
    """The older way of splitting, by document markers; an error if no PDF has a document with text."""
    contents = spark.read.format("binaryFile").load(paths).select("path", "content")
    found = legacy.require_segments(legacy.segments(files.read_pages(contents, parse)))
    made = found.withColumn("page_idxs", F.sequence("start_page", F.col("end_page") - 1)).withColumn("group_no", F.col("document_no"))
    return sinks.write_splits(made, contents.withColumnRenamed("path", "pdf_id"), write, folder)


def split_records(spark: SparkSession, paths: list[str] | str, parse: Parse = backends.parse_pdf, read_strip=None, vision: DataFrame | None = None) -> DataFrame:
    """Records of the credit applications that PDFs would be split into, from their pages: nothing is written or read
    twice.  source_file is where the document goes; vision answers are named by it."""
    contents = spark.read.format("binaryFile").load(paths).select("path", "content")
    pages = _pages(contents, parse, read_strip)
    chosen = forms.credit_applications(grouping.manifest(page_signals(pages, read_strip))).select("pdf_id", "file_name", F.explode("page_idxs").alias("page_idx"))
    text = pages.select("pdf_id", "page_idx", F.col("raw_text").alias("text"))
    whole = chosen.join(text, ["pdf_id", "page_idx"]).groupBy("pdf_id", "file_name").agg(_checkbox_page(), *_text_columns())
    return forms.extract(whole.select(blob_target(F.col("pdf_id"), F.col("file_name")).alias("source_file"), "text", "text_heavy", "checkbox_page"), vision)


def read_forms(contents: DataFrame, parse: Parse = backends.parse_pdf, vision: DataFrame | None = None) -> DataFrame:
    """One record for each form (path, content), an error's where it can't be parsed: the others go on."""

    def run(batches):
        import pandas as pd

        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows += [(path, i, text, None) for i, text in parse(content)] or [(path, 0, "", None)]
                except Exception as e:  # noqa: BLE001  whatever a parser raises is this file's
                    rows.append((path, 0, None, str(e)))
            yield pd.DataFrame(rows, columns=["pdf_id", "page_idx", "text", "error"])

    pages = files.bounded(contents).select("path", "content").mapInPandas(run, "pdf_id string, page_idx int, text string, error string")
    whole = pages.groupBy("pdf_id").agg(F.max("error").alias("error"), _checkbox_page(), *_text_columns())
    good = whole.where("error is null").select(F.col("pdf_id").alias("source_file"), "text", "text_heavy", "checkbox_page")
    bad = whole.where("error is not null").select(forms.error_record(F.col("pdf_id")).alias("r")).select("r.*")
    return forms.extract(good, vision).unionByName(bad)


def _checkbox_page():
    return F.min(F.when(F.contains("text", F.lit(p.CHECKBOX_TEXT)), F.col("page_idx"))).alias("checkbox_page")


def _text_columns() -> list:
    texts = F.transform(F.array_sort(F.collect_list(F.struct("page_idx", F.coalesce("text", F.lit("")).alias("t")))), lambda x: x["t"])
    heavy = F.sum(F.length(F.coalesce("text", F.lit("")))) >= p.TEXT_PAGE_CHARS * F.count("*")
    return [F.array_join(texts, "\n").alias("text"), heavy.alias("text_heavy")]


def forms_to_sheet(spark: SparkSession, folder: str, out: str, parse: Parse = backends.parse_pdf, vision: DataFrame | None = None) -> int:
    """Reads every credit application under folder into one sheet, in the order of their paths; returns how many there
    are, and writes nothing if there are none."""
    every = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", p.CREDIT_APPLICATION_FILE).load(folder)
    records = read_forms(every, parse, vision)
    return sinks.write_sheet(files.by_path(forms.sheet(records), "Source File"), out)


def blob_jobs(spark: SparkSession, root: str, name: str) -> list[str]:
    """The paths to work on: one object, or with * all PDFs, in order."""
    if name != "*":
        return [f"{root.rstrip('/')}/{name}"]
    found = [r.path for r in files.list_blobs(spark, root).collect()]
    if not found:
        raise ValueError(f"there is no PDF under {root}")
    return found


__all__ = ["blob_jobs", "extract", "forms_to_sheet", "ocr_reader", "page_signals", "read_forms", "result_name", "split", "split_by_markers", "split_records"]
