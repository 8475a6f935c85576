"""A made-up stream of five documents behind a cover, for trying the splitters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.wrap import wrap

TITLES = ("Migration Plan", "Data Contract", "Risk Register", "Test Report", "Hand Over")
LINES_A_PAGE = 12


def body(number: Column, words: int) -> Column:
    """Text that is a function of its document's number."""
    return F.array_join(F.transform(F.sequence(F.lit(1), F.lit(words)), lambda i: F.concat(F.lit("word"), ((i * 7 + number * 13) % 97).cast("string"))), " ")


def five_documents(spark: SparkSession, pdf_id: str = "package.pdf", words: int = 150, width: int = 60) -> DataFrame:
    """pdf_id, page_idx, text.  Page 0 is a cover without a mark; each document's first page has its number, title and a
    bare page number, the pages that it runs over to have none."""
    n, titles = len(TITLES), F.array(*[F.lit(t) for t in TITLES])
    docs = spark.range(1, n + 1).select(F.col("id").cast("int").alias("number"), F.get(titles, (F.col("id") - 1).cast("int")).alias("title"))
    lined = docs.withColumn("lines", wrap(body(F.col("number"), words), width))
    pages = lined.select("number", "title", "lines", F.explode(F.sequence(F.lit(0), F.ceil(F.size("lines") / LINES_A_PAGE).cast("int") - 1)).alias("k"))
    text = F.array_join(F.slice("lines", F.col("k") * LINES_A_PAGE + 1, F.lit(LINES_A_PAGE)), "\n")
    head = F.concat(F.lit("DOCUMENT "), F.col("number").cast("string"), F.lit(f" OF {n}\n"), F.upper("title"), F.lit("\nPage "), (F.col("number") + 1).cast("string"), F.lit("\n"))
    cover = spark.range(1).select(F.lit(0).alias("number"), F.lit(0).alias("k"), F.lit("Package\nContents\n" + "\n".join(f"{i}. {t}" for i, t in enumerate(TITLES, 1))).alias("text"))
    every = pages.select("number", "k", F.when(F.col("k") == 0, F.concat(head, text)).otherwise(text).alias("text")).unionByName(cover)
    ordered = F.sort_array(F.collect_list(F.struct("number", "k", "text")))  # a handful of rows
    return every.agg(ordered.alias("p")).select(F.lit(pdf_id).alias("pdf_id"), F.posexplode("p").alias("page_idx", "x")).select("pdf_id", "page_idx", F.col("x.text").alias("text"))
