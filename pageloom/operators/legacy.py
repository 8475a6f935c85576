"""Splitting by document markers, the older way: pages before the first marker belong to no document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as p
from ..functions.text import has_word, lines, strip
from ..functions.titles import is_marked, marker_title, numbered
from .grouping import running_sum


#: What with_marks() adds that says where segments start.
STARTS = ["_marked", "_page_one"]


def with_marks(pages: DataFrame, text: str = "text") -> DataFrame:
    """pages with all that segments need of their texts: marks of starts, whether there is more than white space, and the
    title of a segment that begins here, or null."""
    t = F.coalesce(F.col(text), F.lit(""))
    title = marker_title(lines(t), F.lit(-1), F.lit(None).cast("string"))
    return pages.withColumns({"_marked": is_marked(t), "_page_one": has_word(t, "page") & t.rlike(p.PAGE_ONE_OF), "_not_blank": (strip(t) != "").cast("int"), "_title": title})


def started(marked: DataFrame, pdf: str = "pdf_id", page: str = "page_idx") -> DataFrame:
    """with_marks() of pages, with is_start: the marked pages if a PDF has any, else its first page and those that say page
    1 of n.  Marks are read twice: store them if they are costly."""
    whole = marked.groupBy(F.col(pdf).alias("_pdf")).agg(F.max("_marked").alias("_any"), F.min(page).alias("_first"))
    told = marked.join(whole, F.col(pdf).eqNullSafe(F.col("_pdf")))
    return told.withColumn("is_start", F.when(F.col("_any"), F.col("_marked")).otherwise(F.col("_page_one") | (F.col(page) == F.col("_first")))).select(*marked.columns, "is_start")


def with_starts(pages: DataFrame, pdf: str = "pdf_id", page: str = "page_idx", text: str = "text") -> DataFrame:
    """pages with is_start."""
    return started(with_marks(pages, text), pdf, page).select(*pages.columns, "is_start")


def segments(pages: DataFrame, pdf: str = "pdf_id", page: str = "page_idx", text: str = "text", block: int | None = None) -> DataFrame:
    """One row for each segment that is not blank: pages [start_page, end_page) from 0, its lines, title and file name.

    With block, no window holds more than so many page or segment numbers of a PDF.
    """
    return segments_of(with_marks(pages, text).drop(text), pdf, page, block)


def segments_of(marked: DataFrame, pdf: str = "pdf_id", page: str = "page_idx", block: int | None = None) -> DataFrame:
    """segments() of pages whose texts with_marks() has read.  With block, marks are read many times: store them."""
    numbered_ = running_sum(started(marked, pdf, page), [pdf], page, F.col("is_start").cast("int"), "segment", block).where("segment > 0")
    grouped = numbered_.groupBy(pdf, "segment").agg(
        F.min(page).cast("int").alias("start_page"), (F.max(page) + 1).cast("int").alias("end_page"), F.min_by(F.struct("_title"), F.col(page)).alias("_first"), F.max("_not_blank").alias("_filled")
    ).where("_filled = 1")
    counted = running_sum(grouped, [pdf], "segment", F.lit(1), "_n", block).withColumn("_n", F.col("_n").cast("int"))
    titled = counted.withColumn("base_name", F.coalesce(F.col("_first._title"), F.format_string("Document %d", F.col("_n"))))
    nth = running_sum(titled, [pdf, "base_name"], "segment", F.lit(1), "dup_no", block)
    return nth.withColumn("dup_no", F.col("dup_no").cast("int")).withColumn("file_name", numbered(F.col("base_name"), F.col("dup_no"))).select(pdf, F.col("_n").alias("document_no"), "start_page", "end_page", "base_name", "dup_no", "file_name")


def require_segments(found: DataFrame) -> DataFrame:
    """found, or an error if no PDF has a page with text."""
    if found.isEmpty():
        raise ValueError("no page has text: there is nothing to split")
    return found
