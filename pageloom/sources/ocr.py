"""OCR and images: what runs in Python workers, and what is said about it before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .files import bounded

# How wide a page is drawn, and the strips of it that are read.
RASTER_WIDTH = 1500
TOP_STRIP, BOTTOM_STRIP = 0.25, 0.15
OCR_RESULT = "array<struct<box:array<struct<x:double,y:double>>,text:string,confidence:double>>"


def raster_scale(page_width: Column) -> Column:
    """Up or down to the width of all rasters."""
    return F.lit(float(RASTER_WIDTH)) / page_width


def strip_rows(height: Column, strip: str) -> tuple[Column, Column]:
    """First row of a strip and the row after its last."""
    if strip == "top":
        return F.lit(0), F.floor(height * TOP_STRIP).cast("int")
    return F.floor(height * (1 - BOTTOM_STRIP)).cast("int"), height.cast("int")


def largest_image(images: DataFrame, page: str, width: str = "width", height: str = "height", order: str = "image_no") -> DataFrame:
    """Of each page the image of the largest area, the first of equals, as a struct."""
    rest = [c for c in images.columns if c != page]
    area = F.col(width).cast("long") * F.col(height).cast("long")
    return images.groupBy(page).agg(F.max_by(F.struct(*rest), F.struct(area, -F.col(order))).alias("image"))


def rasters(pdfs: DataFrame, draw: Callable[[bytes, int], bytes | None]) -> DataFrame:
    """pdf_id, page_idx, raster of the pages asked for (pdf_id, content, pages); a PDF's bytes are sent once."""

    def run(batches):
        import pandas as pd

        for batch in batches:
            for pdf, content, wanted in zip(batch["pdf_id"], batch["content"], batch["pages"], strict=True):
                yield pd.DataFrame({"pdf_id": pdf, "page_idx": [int(i) for i in wanted], "raster": [draw(bytes(content), int(i)) for i in wanted]})

    return bounded(pdfs).select("pdf_id", "content", "pages").mapInPandas(run, "pdf_id string, page_idx int, raster binary")


def read_strips(pages: DataFrame, strip: str, model: Callable[[], Callable[[bytes, str], list]], content: str = "raster") -> DataFrame:
    """pages with the column strip (top or bottom): the OCR result of that strip of the raster; an empty one without a
    raster.  model() makes a reader, once in each worker; reader(raster, strip) gives (corners, text, confidence) of each
    line.  A reader's errors are not caught: a result that is missing would look like a page without text."""

    def run(batches):
        reader = model()
        for batch in batches:
            out = []
            for raster in batch[content]:
                lines = [] if raster is None else reader(bytes(raster), strip)
                out.append([{"box": [{"x": float(x), "y": float(y)} for x, y in box], "text": text, "confidence": float(sure)} for box, text, sure in lines])
            yield batch.assign(**{strip: out})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema)
    return bounded(pages).mapInPandas(run, f"{schema}, {strip} {OCR_RESULT}")
