"""All queries over the driver's tables by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as p
from ..functions import text as t
from ..functions import titles
from ..functions.wrap import wrap
from ..operators import documents, forms, grouping, legacy, signals
from ..sources import ocr
from ..sources.state import saved
from . import inputs
from . import sql as s

Query = Callable[[SparkSession, str], DataFrame]


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of all sources.  Signals are made before pages are numbered, and stored, as the manifest reads them
    several times."""
    told = inputs.pages(spark, folder, signals.with_text_signals).select("pdf_id", "page_idx", "classification", "title_text", "total_pages_in_doc")
    return grouping.manifest(saved(told), block=inputs.BLOCK)


def _lined(texts: DataFrame) -> DataFrame:
    return texts.withColumn("l", t.lines(F.col("text")))


def page_lines(spark: SparkSession, folder: str) -> DataFrame:
    found = t.lines(F.coalesce("text", F.lit("")))
    return inputs.read(spark, folder, "documents").withColumn("l", found).select("doc_id", F.size("l").cast("long").alias("n_lines"), F.coalesce(F.get("l", F.lit(0)), F.lit("")).alias("first_line"), F.length(F.array_join("l", "")).cast("long").alias("n_chars"))


def strip_len_route(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return inputs.read(spark, folder, "documents").select("doc_id", F.length(t.strip(text)).cast("long").alias("n_stripped"), signals.needs_ocr(text).alias("is_image"))


def doc_marker_pages(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.pages(spark, folder, lambda texts: texts.withColumn("is_marked", titles.is_marked(F.col("text")))).where("is_marked").select("pdf_id", "page_idx")


def page_n_of_m(spark: SparkSession, folder: str) -> DataFrame:
    found = inputs.pages(spark, folder, lambda texts: texts.withColumn("x", F.get(signals.footers(t.lines(F.col("text"))), F.lit(0))))
    return found.where("x is not null").select("pdf_id", "page_idx", F.col("x.n").alias("page_num"), F.col("x.m").alias("total"))


def meaningful_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = t.lines(F.col("text"))
    return inputs.pages(spark, folder, lambda texts: texts.withColumn("lines", F.array_join(F.filter(lines, titles.is_meaningful), "|")))


def _title(last: bool) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return inputs.pages(spark, folder, lambda texts: _lined(texts).withColumn("title", titles.text_title(F.col("l"), last)).drop("l"))

    return run


def marker_titles(spark: SparkSession, folder: str) -> DataFrame:
    lines = F.col("l")
    title = titles.marker_title(lines, titles.marker_index(lines), F.lit("none"))
    return inputs.pages(spark, folder, lambda texts: _lined(texts).withColumn("title", title).drop("l"))


def text_page_signals(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.pages(spark, folder, signals.with_text_signals)


def group_pages(spark: SparkSession, folder: str) -> DataFrame:
    return grouping.with_groups(inputs.signals(spark, folder)).select("pdf_id", "page_idx", "group_no")


def group_summary(spark: SparkSession, folder: str) -> DataFrame:
    out = grouping.manifest(inputs.signals(spark, folder))
    return out.select("pdf_id", "group_no", "start_page", "end_page", "n_pages", "raw_title", "base_name", "dup_no", "file_name")


def group_members(spark: SparkSession, folder: str) -> DataFrame:
    out = grouping.summarise(grouping.with_groups(inputs.signals(spark, folder)))
    return out.select("pdf_id", "group_no", F.array_join("page_idxs", ",").alias("page_idxs"))


def split_manifest(spark: SparkSession, folder: str) -> DataFrame:
    out = _manifest(spark, folder)
    return out.select("pdf_id", "group_no", "start_page", "end_page", "n_pages", "raw_title", "file_name")


def legacy_starts(spark: SparkSession, folder: str) -> DataFrame:
    return legacy.started(saved(inputs.pages(spark, folder, legacy.with_marks).select("pdf_id", "page_idx", *legacy.STARTS))).where("is_start").select("pdf_id", "page_idx")


def legacy_segments(spark: SparkSession, folder: str) -> DataFrame:
    return legacy.segments_of(saved(inputs.pages(spark, folder, legacy.with_marks)), block=inputs.BLOCK)


def ocr_flatten(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.ocr_results(spark, folder).select("page", F.array_join(signals.flat_ocr(F.col("bottom")), "|").alias("bottom"), F.array_join(signals.flat_ocr(F.col("top")), "|").alias("top"))


def ocr_best_title(spark: SparkSession, folder: str) -> DataFrame:
    """By aggregation over lines: the first of the highest scores."""
    lines = inputs.ocr(spark, folder).where("strip = 'top'").withColumn("score", signals.title_score(F.col("text"), F.col("height")))
    best = F.max_by(F.struct(t.strip(F.col("text")).alias("t"), "score"), F.struct("score", -F.col("line_no")))
    return lines.where(F.col("score") >= p.TITLE_MIN_SCORE).groupBy("page").agg(best.alias("b")).select("page", F.col("b.t").alias("title"), F.col("b.score").alias("score"))


def image_page_signals(spark: SparkSession, folder: str) -> DataFrame:
    x = inputs.ocr_results(spark, folder)
    return x.withColumn("s", signals.image_page_signal(F.col("page") % 17 != 0, F.col("bottom"), F.col("top"))).select("page", "s.*")


def sanitize_filename(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.expr("concat(' ', p_name, CASE p_partkey % 4 WHEN 0 THEN ' : <a|b>? ' WHEN 1 THEN concat(chr(9), ' x', chr(10)) ELSE '' END)")
    return inputs.read(spark, folder, "part").select("p_partkey", t.sanitize_filename(raw).alias("name"), t.sanitize_filename(F.lit('<>:"?*')).alias("nothing"))


def sanitize_title(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.read(spark, folder, "documents").select("doc_id", t.sanitize_title(F.coalesce("text", F.lit(""))).alias("title"))


def title_case(spark: SparkSession, folder: str) -> DataFrame:
    name = F.expr("concat(upper(p_name), ' O''NEIL 2ND')")
    return inputs.read(spark, folder, "part").select("p_partkey", t.title_case(name).alias("title"), t.is_upper(name).alias("is_upper"), t.is_upper(F.col("p_name")).alias("name_is_upper"), t.is_upper(F.lit("12 -")).alias("no_letter"))


def whole_documents(spark: SparkSession, folder: str) -> DataFrame:
    out = documents.documents(inputs.conversations(spark, folder))
    return out.select("pdf_id", "page_count", F.length("combined_text").cast("long").alias("combined_len"), F.md5("combined_text").alias("combined_md5"), F.length("all_text").cast("long").alias("all_len"), F.md5("all_text").alias("all_md5"), "total_chars", "text_heavy")


def first_page_with(spark: SparkSession, folder: str) -> DataFrame:
    return documents.first_page_with(inputs.conversations(spark, folder), "the")


def document_json(spark: SparkSession, folder: str) -> DataFrame:
    nested = documents.nested(inputs.conversations(spark, folder))
    back = F.from_json("json", "page_count long, combined_text string, pages array<struct<page_number:int,text:string>>")
    return documents.as_json(nested).select("source_path", back.alias("b")).select("source_path", F.col("b.page_count").alias("page_count"), F.md5("b.combined_text").alias("combined_md5"), F.col("b.pages")[0]["page_number"].alias("first_page"))


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.when(F.col("p_partkey") % 3 != 0, F.create_map(F.lit("/Title"), F.col("p_name"), F.lit("//Type"), F.col("p_type"), F.lit("Size"), F.when(F.col("p_size") > 10, F.col("p_size").cast("string"))))
    m = documents.normalise_metadata(raw)
    return inputs.read(spark, folder, "part").select("p_partkey", F.size(m).cast("long").alias("n"), F.try_element_at(m, F.lit("Title")).alias("title"), F.try_element_at(m, F.lit("Type")).alias("type"), F.try_element_at(m, F.lit("Size")).alias("size"))


def form_types(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.forms(spark, folder).select("c_custkey", forms.form_type(F.col("text")).alias("form_type"), "text_heavy", "checkbox_page")


def routeone_fields(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    last, first = forms.routeone_name(text)
    return inputs.forms(spark, folder).select("c_custkey", last.alias("last_name"), first.alias("first_name"), F.array_join(forms.routeone_phones(text), "|").alias("phones"), forms.routeone_consent(text).alias("consent"))


def dealertrack_fields(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    last, first = forms.dealertrack_name(text)
    return inputs.forms(spark, folder).select("c_custkey", last.alias("last_name"), first.alias("first_name"), F.array_join(forms.dealertrack_phones(text), "|").alias("phones"))


def unique_phones(spark: SparkSession, folder: str) -> DataFrame:
    found = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({p.PHONE_LIKE})"), F.lit(1))
    return inputs.read(spark, folder, "documents").select("doc_id", F.array_join(forms.unique_phones(found), "|").alias("phones"))


def credit_app_records(spark: SparkSession, folder: str) -> DataFrame:
    out = forms.extract(inputs.forms(spark, folder), inputs.vision(spark, folder))
    return out.withColumn("telemarketing_phones", F.array_join("telemarketing_phones", "|"))


def opt_in_sheet(spark: SparkSession, folder: str) -> DataFrame:
    out = forms.sheet(forms.extract(inputs.forms(spark, folder), inputs.vision(spark, folder)))
    return out.toDF(*[c.lower().replace(" ", "_") for c in out.columns])


def vision_requests(spark: SparkSession, folder: str) -> DataFrame:
    return forms.needs_vision(inputs.forms(spark, folder)).select("source_file", "page")


def credit_app_selection(spark: SparkSession, folder: str) -> DataFrame:
    return forms.credit_applications(_manifest(spark, folder)).select("pdf_id", "group_no")


def pdf_discovery(spark: SparkSession, folder: str) -> DataFrame:
    """The names of pages as if each were a file: those that count as PDFs, where results of each go."""
    path = F.expr("concat(split_part(url, '://', 2), CASE page_id % 4 WHEN 0 THEN '.pdf' WHEN 1 THEN '.PDF' ELSE '.txt' END)")
    named = inputs.read(spark, folder, "pages").select("page_id", path.alias("path")).where(F.lower("path").endswith(".pdf"))
    return named.select("page_id", F.col("path").endswith(".pdf").alias("in_folder_scan"), t.output_name(F.col("path"), "json").alias("output_name"), t.blob_target(F.col("path"), F.lit("part.pdf")).alias("blob"))


def wrapped_lines(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.read(spark, folder, "documents").select("doc_id", F.array_join(wrap(F.coalesce("text", F.lit("")), 24), "|").alias("lines"))


def largest_image(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of an order stand for the images of a page."""
    line = "(CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey) * 1000000 + l_suppkey"
    images = inputs.read(spark, folder, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_quantity").cast("int").alias("width"), (F.col("l_suppkey") % 7).alias("height"), F.expr(line).alias("image_no"))
    return ocr.largest_image(images, "page").select("page", "image.width", "image.height", "image.image_no")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        page_lines, strip_len_route, doc_marker_pages, page_n_of_m, meaningful_lines, marker_titles, text_page_signals, group_pages, group_summary, group_members, split_manifest, legacy_starts, legacy_segments,
        ocr_flatten, ocr_best_title, image_page_signals, sanitize_filename, sanitize_title, title_case, whole_documents, first_page_with, document_json, metadata, form_types, routeone_fields,
        dealertrack_fields, unique_phones, credit_app_records, opt_in_sheet, vision_requests, credit_app_selection, pdf_discovery, wrapped_lines, largest_image,
    )
}
QUERIES |= {"title_first": _title(False), "title_last": _title(True)}

ORACLE_SQL: dict[str, str] = s.ORACLE_SQL
