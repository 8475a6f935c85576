"""Whole documents from their pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as p


def normalise_metadata(metadata: Column) -> Column:
    """Keys without leading slashes, a null map as an empty one.  Set spark.sql.mapKeyDedupPolicy to LAST_WIN if keys
    may become equal."""
    entries = F.transform(F.map_entries(metadata), lambda e: F.struct(F.ltrim(e["key"], F.lit("/")).alias("key"), e["value"].cast("string").alias("value")))
    return F.coalesce(F.map_from_entries(entries), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))


def _in_order(page: str, text: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.coalesce(F.col(text), F.lit("")).alias("t")))), lambda x: x["t"])


def documents(pages: DataFrame, pdf: str = "pdf_id", page: str = "page_idx", text: str = "text") -> DataFrame:
    """One row for each document: page_count, combined_text (texts that are not empty, an empty line between),
    all_text (all texts, line by line), total_chars and text_heavy (so many characters a page as digital text has)."""
    texts = _in_order(page, text)
    total = F.sum(F.length(F.coalesce(F.col(text), F.lit("")))).cast("long")
    return pages.groupBy(pdf).agg(
        F.count("*").alias("page_count"), F.array_join(F.filter(texts, lambda t: t != ""), "\n\n").alias("combined_text"), F.array_join(texts, "\n").alias("all_text"),
        total.alias("total_chars"), (total >= p.TEXT_PAGE_CHARS * F.count("*")).alias("text_heavy"),
    )


def first_page_with(pages: DataFrame, literal: str, pdf: str = "pdf_id", page: str = "page_idx", text: str = "text") -> DataFrame:
    """The least page of each document whose text holds the literal; null if none does."""
    return pages.groupBy(pdf).agg(F.min(F.when(F.contains(F.col(text), F.lit(literal)), F.col(page))).alias("first_page"))


def nested(pages: DataFrame, metadata: DataFrame | None = None, pdf: str = "pdf_id", page: str = "page_idx", text: str = "text") -> DataFrame:
    """source_path, page_count, metadata, pages array<struct<page_number,text>>, combined_text."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.coalesce(F.col(text), F.lit("")).alias("t")))), lambda x: F.struct((x["p"] + 1).cast("int").alias("page_number"), x["t"].alias("text")))
    out = pages.groupBy(F.col(pdf).cast("string").alias("source_path")).agg(F.count("*").alias("page_count"), listed.alias("pages"))
    if metadata is None:
        out = out.withColumn("metadata", normalise_metadata(F.lit(None).cast("map<string,string>")))
    else:
        out = out.join(metadata.select(F.col(pdf).cast("string").alias("source_path"), normalise_metadata(F.col("metadata")).alias("metadata")), "source_path", "left")
    texts = F.transform(F.filter("pages", lambda x: x["text"] != ""), lambda x: x["text"])
    return out.select("source_path", "page_count", "metadata", "pages", F.array_join(texts, "\n\n").alias("combined_text"))


def as_json(docs: DataFrame) -> DataFrame:
    """source_path and the document as JSON, nulls written out; equal in content, not in bytes, to other writers'."""
    return docs.select("source_path", F.to_json(F.struct("source_path", "page_count", "metadata", "pages", "combined_text"), {"ignoreNullFields": "false"}).alias("json"))
