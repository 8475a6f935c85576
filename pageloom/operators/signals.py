"""What a page says about where documents begin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as p
from ..functions.text import digit_count, has_word, lines, once, strip, words
from ..functions.titles import content_title, is_marked, marker_index, marker_title, text_title

NEW, MORE, UNSURE = "NEW_DOC", "CONTINUATION", "AMBIGUOUS"
SIGNAL = "struct<classification:string,title_text:string,page_num_in_doc:int,total_pages_in_doc:int>"


def _signal(kind: str, title: Column | None = None, page: Column | None = None, total: Column | None = None) -> Column:
    none = F.lit(None)
    return F.struct(
        F.lit(kind).alias("classification"), (none if title is None else title).cast("string").alias("title_text"),
        (none if page is None else page).cast("int").alias("page_num_in_doc"), (none if total is None else total).cast("int").alias("total_pages_in_doc"),
    )


def _number(c: Column) -> Column:
    """Numbers beyond an int count as the largest."""
    return F.when(F.length(F.regexp_replace(c, "^0+", "")) > 9, F.lit(2**31 - 1)).otherwise(c.try_cast("int"))


def page_of(line: Column) -> Column:
    """(n, m) of the first "Page n of m"; null if the line has none."""
    return F.when(line.rlike(p.PAGE_N_OF_M), F.struct(_number(F.regexp_extract(line, p.PAGE_N_OF_M, 1)).alias("n"), _number(F.regexp_extract(line, p.PAGE_N_OF_M, 2)).alias("m")))


def footers(texts: Column) -> Column:
    return F.filter(F.transform(F.filter(texts, lambda x: has_word(x, "page")), page_of), lambda x: x.isNotNull())


def needs_ocr(text: Column) -> Column:
    return F.length(strip(F.coalesce(text, F.lit("")))) < p.TEXT_PAGE_CHARS


def route(pages: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Pages with text, and pages that are images: two frames, so that what is costly for images never sees the others."""
    image = needs_ocr(F.col(text_col))
    return pages.where(~image), pages.where(image)


def text_page_signal(text: Column, page_lines: Column) -> Column:
    """The rules for a page with text; page_lines are its lines()."""
    titled = once(F.coalesce(content_title(text), text_title(page_lines)), lambda title: F.when(title.isNotNull(), _signal(NEW, title)).otherwise(_signal(UNSURE)))
    unmarked = once(
        F.get(F.filter(footers(page_lines), lambda x: x["n"] >= 1), F.lit(0)),
        lambda first: F.when(first["n"] > 1, _signal(MORE, None, first["n"], first["m"]))
        .when(first["n"] == 1, _signal(NEW, text_title(page_lines, prefer_last=True), F.lit(1), F.when(first["m"] > 1, first["m"])))
        .otherwise(titled),
    )
    return F.when(is_marked(text), _signal(NEW, marker_title(page_lines, marker_index(page_lines), F.lit(None).cast("string")), F.lit(1))).otherwise(unmarked)


def with_text_signals(pages: DataFrame, text_col: str = "text") -> DataFrame:
    """pages with the signal's four columns.  The lines are made once for each page; rules are tried in order."""
    return pages.withColumn("_lines", lines(F.col(text_col))).withColumn("_signal", text_page_signal(F.col(text_col), F.col("_lines"))).select(*pages.columns, "_signal.*")


def flat_ocr(result: Column) -> Column:
    """The texts of an OCR result's lines, in order; an empty array for null."""
    return F.coalesce(F.transform(F.filter(result, lambda x: x.isNotNull() & x["text"].isNotNull()), lambda x: x["text"]), F.array().cast("array<string>"))


def box_height(box: Column) -> Column:
    ys = F.transform(box, lambda q: q["y"])
    return F.coalesce(F.array_max(ys) - F.array_min(ys), F.lit(0.0))


def title_score(text: Column, height: Column) -> Column:
    """How much a line of OCR looks like a title; null if it can't be one."""
    s = strip(text)
    n = F.size(words(s))
    small = F.size(F.filter(words(s), lambda w: (F.length(w) > 2) & (w == F.lower(w)) & (w != F.upper(w))))
    fine = F.length(s).between(p.TITLE_MIN_CHARS, p.TITLE_MAX_CHARS) & ~s.rlike("[:(#@]") & (digit_count(s) < 7) & (n <= 8) & (small < 2)
    return F.when(fine, height * F.when(n >= 2, F.lit(2.0)).otherwise(F.lit(0.3)))


def best_ocr_title(result: Column) -> Column:
    """The line of the highest score, the first of equals, if that is high enough."""
    scored = F.transform(result, lambda x, i: F.struct(title_score(x["text"], box_height(x["box"])).alias("score"), (-i).alias("place"), strip(x["text"]).alias("text")))
    best = F.array_max(F.filter(scored, lambda x: x["score"] >= p.TITLE_MIN_SCORE))
    return best["text"]


def image_page_signal(has_image: Column, bottom: Column, top: Column) -> Column:
    """The rules for an image: bottom and top are OCR results, array<struct<box,text,..>>, of its strips."""
    found = footers(flat_ocr(bottom))
    more = F.get(F.filter(found, lambda x: x["n"] > 1), F.lit(0))
    total = F.try_element_at(F.filter(found, lambda x: (x["n"] == 1) & (x["m"] > 1)), F.lit(-1))["m"]
    page = F.when(total.isNotNull(), F.lit(1))
    inferred, title = content_title(F.array_join(F.concat(flat_ocr(bottom), flat_ocr(top)), " ")), best_ocr_title(top)
    return (
        F.when(~has_image, _signal(UNSURE))
        .when(more.isNotNull(), _signal(MORE, None, more["n"], more["m"]))
        .when(inferred.isNotNull(), _signal(NEW, inferred, page, total))
        .when(title.isNotNull(), _signal(NEW, title, page, total))
        .when(total.isNotNull(), _signal(NEW, None, page, total))
        .otherwise(_signal(UNSURE))
    )


def ocr_stages(images: DataFrame, read_strip) -> DataFrame:
    """Signals of image pages with as little OCR as they need: the bottom strip of each, the top strip of those that the
    bottom doesn't settle.  read_strip(frame, "bottom" or "top") adds that column with an OCR result."""
    low = read_strip(images, "bottom")
    settled = F.exists(footers(flat_ocr(F.col("bottom"))), lambda x: x["n"] > 1)
    none = F.lit(None).cast(low.schema["bottom"].dataType)
    return low.where(settled).withColumn("top", none).unionByName(read_strip(low.where(~settled), "top"))
