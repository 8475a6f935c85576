"""Page streams, signals, OCR lines and forms made out of the driver's tables, with marks put in by rules.

Each is said twice: as a frame, and as SQL for the other engine (the constants in capitals).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.grouping import running_sum

#: Page numbers of one window, at most: a source may hold a large share of all documents.
BLOCK = 4096

# What goes before a document's text, in words that both dialects know.
_PREFIX = """CASE CAST(doc_id % 11 AS INT)
 WHEN 0 THEN concat('DOCUMENT ', CAST(doc_id % 5 + 1 AS STRING), ' OF 5', chr(10), 'Page 3', chr(10))
 WHEN 1 THEN concat('FEDERAL DISCLOSURE BOX', chr(10), 'RETAIL SALE CONTRACT**', chr(10), 'Page 1 of ', CAST(doc_id % 4 + 1 AS STRING), chr(10))
 WHEN 2 THEN concat('left over', chr(10), 'page  ', CAST(doc_id % 3 + 2 AS STRING), ' OF 4 right', chr(10))
 WHEN 3 THEN concat('FORM NO. 12 OF STATE', chr(10), 'RETAIL INSTALLMENT CONTRACT', chr(10))
 WHEN 4 THEN concat('RouteOne:', chr(10), 'Credit Application', chr(10))
 WHEN 5 THEN concat('DT 6/17', chr(10), 'INCOMPLETE  APPLICATIONS WILL NOT BE PROCESSED', chr(10))
 WHEN 6 THEN concat('Page 0 of 9', chr(10), 'Make Trim VIN', chr(10), 'A. Section Head', chr(10), 'Bill Of Sale', chr(10))
 WHEN 7 THEN concat('Non-Authoritative Copy', chr(10), 'DOCUMENT 1 OF', chr(10), '2', chr(10), 'O''NEIL 2ND NOTICE', chr(10))
 ELSE '' END"""
# Made-up lines stand before each whole text; short and empty pages are those whose text is.
_TEXT = f"concat({_PREFIX}, coalesce(text, ''))"

PAGES = f"""pages_src AS (SELECT source AS pdf_id, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS INT) AS page_idx, {_TEXT} AS text FROM documents)"""


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _spread(df: DataFrame, key: str) -> DataFrame:
    """df, dealt out by key where its files give fewer tasks than there are cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def pages(spark: SparkSession, folder: str, told: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """pdf_id, page_idx from 0, text; or, instead of text, the columns that told() makes of the text of each page.

    told is asked before pages are numbered, so that texts pass through no window; it must keep all rows and their columns
    pdf_id and doc_id.
    """
    texts = _spread(read(spark, folder, "documents").select("source", "doc_id", "text"), "doc_id")
    texts = texts.select(F.col("source").alias("pdf_id"), "doc_id", F.expr(_TEXT).alias("text"))
    numbers = running_sum(told(texts).drop("text") if told else texts, ["pdf_id"], "doc_id", F.lit(1), "nth", BLOCK)
    made = [c for c in numbers.columns if c not in ("pdf_id", "doc_id", "nth")]
    return numbers.select("pdf_id", (F.col("nth") - 1).cast("int").alias("page_idx"), *made)


_KIND = "CASE event_type WHEN 'signup' THEN 'NEW_DOC' WHEN 'purchase' THEN 'CONTINUATION' WHEN 'click' THEN 'CONTINUATION' ELSE 'AMBIGUOUS' END"
_TOTAL = "CASE event_type WHEN 'purchase' THEN 3 WHEN 'click' THEN 4 END"
_TITLE = "CASE WHEN event_type = 'signup' AND event_id % 3 > 0 THEN concat('Form ', CAST(event_id % 7 AS STRING), '/é!') WHEN event_type = 'signup' AND event_id % 2 = 0 THEN '' END"
SIGNALS = f"""signals_src AS (SELECT user_id AS pdf_id, event_id AS page_idx, {_KIND} AS classification, {_TITLE} AS title_text, {_TOTAL} AS total_pages_in_doc FROM events)"""


def signals(spark: SparkSession, folder: str) -> DataFrame:
    e = read(spark, folder, "events")
    return e.select(F.col("user_id").alias("pdf_id"), F.col("event_id").alias("page_idx"), F.expr(_KIND).alias("classification"), F.expr(_TITLE).alias("title_text"), F.expr(_TOTAL).alias("total_pages_in_doc"))


CONVERSATIONS = "conv_src AS (SELECT conv_id AS pdf_id, CAST(turn AS INT) AS page_idx, text FROM conversations)"


def conversations(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "conversations").select(F.col("conv_id").alias("pdf_id"), F.col("turn").cast("int").alias("page_idx"), "text")


_OCR_TEXT = """CASE CAST((l_partkey + l_linenumber) % 9 AS INT)
 WHEN 0 THEN concat('Page ', CAST(l_linenumber AS STRING), ' of ', CAST(l_suppkey % 4 AS STRING))
 WHEN 1 THEN concat('State Tax ', l_returnflag) WHEN 2 THEN 'Invoice' WHEN 3 THEN 'Name: of buyer' WHEN 4 THEN 'se nag tor stot'
 WHEN 5 THEN concat('Call 847-882-', CAST(l_partkey AS STRING)) WHEN 6 THEN ' Bill of Sale ' WHEN 7 THEN NULL ELSE 'DT 5/23 INCOMPLETE APPLICATIONS WILL NOT BE PROCESSED' END"""
_LINE = "(CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey) * 1000000 + l_suppkey"  # an order can repeat its line numbers
OCR = f"""ocr_src AS (SELECT l_orderkey AS page, {_LINE} AS line_no, CASE WHEN l_suppkey % 3 = 0 THEN 'bottom' ELSE 'top' END AS strip, {_OCR_TEXT} AS text, CAST(l_quantity AS DOUBLE) AS height FROM lineitem)"""


def ocr(spark: SparkSession, folder: str) -> DataFrame:
    """page, line_no, strip, text, height of each line of OCR."""
    li = read(spark, folder, "lineitem")
    return li.select(F.col("l_orderkey").alias("page"), F.expr(_LINE).alias("line_no"), F.expr("CASE WHEN l_suppkey % 3 = 0 THEN 'bottom' ELSE 'top' END").alias("strip"), F.expr(_OCR_TEXT).alias("text"), F.col("l_quantity").cast("double").alias("height"))


def ocr_results(spark: SparkSession, folder: str) -> DataFrame:
    """page, bottom, top: OCR results of its strips, with boxes."""
    corner = lambda x, y: F.struct(F.lit(float(x)).alias("x"), y.alias("y"))
    low, high = F.lit(10.0), F.lit(10.0) + F.col("height")
    box = F.array(corner(0, low), corner(9, low), corner(9, high), corner(0, high))
    lines = ocr(spark, folder).select("page", "strip", F.struct("line_no", F.struct(box.alias("box"), F.col("text"), F.lit(0.9).alias("confidence")).alias("line")).alias("x"))
    of = lambda name: F.transform(F.array_sort(F.collect_list(F.when(F.col("strip") == name, F.col("x")))), lambda x: x["line"])
    return lines.groupBy("page").agg(of("bottom").alias("bottom"), of("top").alias("top"))


_DIGITS = "lpad(CAST(c_custkey AS STRING), 4, '0')"
_FORM = f"""CASE CAST(c_custkey % 5 AS INT)
 WHEN 0 THEN concat('RouteOne', chr(10), 'Credit Application: Applicant', chr(10), CASE WHEN c_custkey % 2 = 0 THEN 'Mr. ' WHEN c_custkey % 3 = 0 THEN 'Dr' ELSE '' END, c_mktsegment, ' First', CAST(c_nationkey AS STRING), ' 01/01/1980', chr(10),
  'at the following telephone number(s): 312-555-', {_DIGITS}, ', 312555', {_DIGITS}, '; 555-0101, +1 847 555 ', {_DIGITS}, '. End', chr(10),
  'Optional Consent text', chr(10), 'Applicant: By Date ', CASE WHEN c_nationkey % 2 = 0 THEN '1/2/2024' ELSE '' END, chr(10), 'Source: R1 3/4/2024', chr(10))
 WHEN 1 THEN concat('Application DT 5/23', chr(10), 'DOE JANE 000-00-0000', chr(10), 'at the following number(s) (312) 555-', {_DIGITS}, ', 312.555.', {_DIGITS}, ' x including any cell phone numbers', chr(10), CASE WHEN c_nationkey % 3 = 0 THEN 'You opt in here' ELSE '' END)
 WHEN 2 THEN concat('Form dt 6', chr(10), upper(c_mktsegment), ' LEE 123-45-6789 at the following number(s)', chr(10), 'You understand')
 WHEN 3 THEN concat('Credit Application: Applicant RouteOne', chr(10), c_name)
 ELSE concat('no form at all ', c_name) END"""
FORMS = f"""forms_src AS (SELECT c_custkey, concat('in/', c_mktsegment, '/', c_name, '.pdf') AS source_file, {_FORM} AS text FROM customer),
forms AS (SELECT *, length(text) >= 50 * (1 + c_custkey % 3) AS text_heavy, CASE WHEN contains(text, 'You opt in') THEN 0 END AS checkbox_page FROM forms_src)"""


def forms(spark: SparkSession, folder: str) -> DataFrame:
    c = read(spark, folder, "customer").select("c_custkey", F.expr("concat('in/', c_mktsegment, '/', c_name, '.pdf')").alias("source_file"), F.expr(_FORM).alias("text"))
    return c.withColumn("text_heavy", F.length("text") >= 50 * (1 + F.col("c_custkey") % 3)).withColumn("checkbox_page", F.when(F.contains("text", F.lit("You opt in")), F.lit(0)))


_ANSWER = """CASE CAST(c_custkey % 4 AS INT) WHEN 0 THEN concat('{"last_name":"V', CAST(c_custkey AS STRING), '","opt_in_status":"opted_in","telemarketing_phones":["1","2","3","4"],"confidence":"medium"}')
 WHEN 1 THEN '{"first_name":"F","telemarketing_phones":null}' WHEN 2 THEN 'not json' END"""
VISION = f"vision AS (SELECT source_file, {_ANSWER} AS answer FROM forms_src WHERE c_custkey % 4 < 3)"


def vision(spark: SparkSession, folder: str) -> DataFrame:
    return forms(spark, folder).where("c_custkey % 4 < 3").select("source_file", F.expr(_ANSWER).alias("answer"))
