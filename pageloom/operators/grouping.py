"""From page signals to logical documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import sanitize_title
from ..functions.titles import fallback_name, numbered


def _start(first: Column, before: Column, anchored: Column) -> Column:
    """Whether a page begins a document: before is the total of the page before it, if that was settled."""
    return (
        F.when(first, 1)
        .when(F.col("classification") == "NEW_DOC", F.coalesce(anchored, F.lit(False)).cast("int"))
        .when(F.col("classification") == "CONTINUATION", F.coalesce((before != F.col("total_pages_in_doc")).cast("int"), F.lit(0)))
        .otherwise(0)
    )


def _settled() -> Column:
    return F.col("classification") != "AMBIGUOUS"


def with_groups(signals: DataFrame, pdf: str = "pdf_id", page: str = "page_idx", block: int | None = None) -> DataFrame:
    """signals with group_no, from 1 in each PDF.

    A new document begins at a first page if any page before it was settled, and at a continuation whose total differs
    from that of the page just before.  One exchange and one sort by PDF serve all windows.

    With block, a PDF is cut into ranges of so many page numbers, which are windows of their own; what each range needs
    of those before it comes from a row for each range.  For keys that hold more pages than one task should.
    """
    if block:
        return _with_groups_by_block(signals, pdf, page, block)
    w = Window.partitionBy(pdf).orderBy(page)
    before = F.lag(F.when(_settled(), F.col("total_pages_in_doc"))).over(w)
    anchored = F.max(_settled()).over(w.rowsBetween(Window.unboundedPreceding, -1))
    start = _start(F.row_number().over(w) == 1, before, anchored)
    return signals.withColumn("is_start", start).withColumn("group_no", F.sum("is_start").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("is_start")


def _with_groups_by_block(signals: DataFrame, pdf: str, page: str, block: int) -> DataFrame:
    cut = signals.withColumn("_block", F.floor(F.col(page) / block))
    within, across = Window.partitionBy(pdf, "_block").orderBy(page), Window.partitionBy("_pdf").orderBy("_nth")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    total = F.when(_settled(), F.col("total_pages_in_doc"))

    def join(rows: DataFrame, blocks: DataFrame) -> DataFrame:
        return rows.join(blocks, rows[pdf].eqNullSafe(blocks["_pdf"]) & (rows["_block"] == blocks["_nth"])).drop("_pdf", "_nth")

    ends = cut.groupBy(F.col(pdf).alias("_pdf"), F.col("_block").alias("_nth")).agg(F.max_by(F.struct(total.alias("t")), page).alias("last"), F.max(_settled()).alias("any"))
    ends = ends.select("_pdf", "_nth", (F.row_number().over(across) == 1).alias("_opens"), F.lag("last.t").over(across).alias("_left"), F.max("any").over(earlier).alias("_any"))
    rows = cut.withColumns({"_top": F.row_number().over(within) == 1, "_lag": F.lag(total).over(within), "_seen": F.max(_settled()).over(within.rowsBetween(Window.unboundedPreceding, -1))})
    told = join(rows, ends)
    told = told.withColumn("is_start", _start(F.col("_top") & F.col("_opens"), F.when(F.col("_top"), F.col("_left")).otherwise(F.col("_lag")), F.coalesce("_any", F.lit(False)) | F.coalesce("_seen", F.lit(False))))
    sums = told.groupBy(F.col(pdf).alias("_pdf"), F.col("_block").alias("_nth")).agg(F.sum("is_start").alias("n"))
    sums = sums.select("_pdf", "_nth", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_offset"))
    group = (F.col("_offset") + F.sum("is_start").over(within.rowsBetween(Window.unboundedPreceding, 0))).cast("int")
    return join(told, sums).withColumn("group_no", group).select(*signals.columns, "group_no")


def running_sum(rows: DataFrame, keys: list[str], order: str, value: Column, name: str, block: int | None = None) -> DataFrame:
    """rows with name: the sum of value over the rows of the same keys up to each, by order, a whole number.

    With block, ranges of so many numbers of order are windows of their own, and a row for each range carries the sums of
    those before it: for keys that may hold a large share of all rows.  rows are then evaluated twice.
    """
    if not block:
        return rows.withColumn(name, F.sum(value).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))
    cut = rows.withColumn("_range", F.floor(F.col(order) / block))
    own = [f"_key{i}" for i in range(len(keys))]
    sums = cut.groupBy(*[F.col(k).alias(o) for k, o in zip(keys, own, strict=True)], F.col("_range").alias("_nth")).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*own).orderBy("_nth").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*own, "_nth", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    same = F.col("_range").eqNullSafe(F.col("_nth"))
    for k, o in zip(keys, own, strict=True):
        same = same & F.col(k).eqNullSafe(F.col(o))
    within = Window.partitionBy(*keys, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return cut.join(sums, same).withColumn(name, F.col("_before") + F.sum(value).over(within)).select(*rows.columns, name)


def summarise(grouped: DataFrame, pdf: str = "pdf_id", page: str = "page_idx") -> DataFrame:
    """One row for each group: its pages in order, first and last from 1, and the first title that is not empty."""
    title = F.min_by("title_text", F.when(F.col("title_text") != "", F.col(page)))
    titled = F.max((F.coalesce(F.col("title_text"), F.lit("")) != "").cast("int")) == 1
    return grouped.groupBy(pdf, "group_no").agg(
        F.sort_array(F.collect_list(page)).alias("page_idxs"), (F.min(page) + 1).cast("int").alias("start_page"), (F.max(page) + 1).cast("int").alias("end_page"),
        F.count("*").alias("n_pages"), F.when(titled, title).alias("raw_title"),
    )


def base_name(title: Column, first: Column, last: Column) -> Column:
    return F.when(F.coalesce(title, F.lit("")) != "", sanitize_title(title)).otherwise(fallback_name(first, last))


def with_file_names(groups: DataFrame, pdf: str = "pdf_id", block: int | None = None) -> DataFrame:
    """groups with base_name, dup_no and file_name; names are numbered in the order of groups of one PDF."""
    named = groups.withColumn("base_name", base_name(F.col("raw_title"), F.col("start_page"), F.col("end_page")))
    nth = running_sum(named, [pdf, "base_name"], "group_no", F.lit(1), "dup_no", block)
    return nth.withColumn("dup_no", F.col("dup_no").cast("int")).withColumn("file_name", numbered(F.col("base_name"), F.col("dup_no")))


def manifest(signals: DataFrame, pdf: str = "pdf_id", page: str = "page_idx", block: int | None = None) -> DataFrame:
    """The documents that a PDF is split into.

    With block, no window holds more than so many page or group numbers; signals are then evaluated several times, so
    persist those that are costly.
    """
    return with_file_names(summarise(with_groups(signals, pdf, page, block), pdf, page), pdf, block)
