"""Finding and reading input files."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip

#: Files and their bytes that a Python worker is handed at once, at most.
BATCH_FILES, BATCH_BYTES = 64, 64 << 20


def bounded(df: DataFrame) -> DataFrame:
    """df, once the session's limits of Arrow batches are no higher than BATCH_FILES and BATCH_BYTES."""
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_FILES), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = conf.get(key).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            conf.set(key, str(most))
    return df


def by_path(files: DataFrame, col: str = "path") -> DataFrame:
    """In the order of paths, part by part."""
    return files.orderBy(F.split(col, "/"))


def discover(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """path, length of the PDFs at path, in order.  A folder's names end in .pdf, as written; a single file's may end in
    .PDF as well, else it is an error.  Names that begin with . or _ are not seen.  Contents are not read."""
    return by_path(_found(spark, path, recursive).select("path", "length"))


def contents(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """path, content of the PDFs that discover() names; read by the executors."""
    return _found(spark, path, recursive).select("path", "content")


def _found(spark: SparkSession, path: str, recursive: bool) -> DataFrame:
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(place):
        raise FileNotFoundError(path)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")  # else folders of folders are taken for partitions
    if fs.getFileStatus(place).isFile():
        if not path.lower().endswith(".pdf"):
            raise ValueError(f"not a PDF: {path}")
        return reader.load(re.sub(r"([\[\]{}*?\\])", r"\\\1", path))
    if recursive:
        return reader.option("pathGlobFilter", "*.pdf").load(path)
    inside = re.sub(r"([\[\]{}*?\\])", r"\\\1", path.rstrip("/")) + "/*.pdf"  # this folder only is listed
    if not fs.globStatus(jvm.org.apache.hadoop.fs.Path(inside)):
        return spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary")
    depth = fs.makeQualified(place).toString().rstrip("/").count("/") + 1
    return reader.load(inside).where(F.regexp_count(F.col("path"), F.lit("/")) <= F.lit(depth))


def list_blobs(spark: SparkSession, uri: str) -> DataFrame:
    """name of each object under uri that ends in .pdf, in any case, in order."""
    root = uri.rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    return files.where(F.lower("path").endswith(".pdf")).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "path").orderBy("name")


def storage_options(account: str, key: str) -> dict[str, str]:
    """Settings that open an object store account to Spark."""
    if not account or not key:
        raise OSError("an account and its key are needed")
    return {f"spark.hadoop.fs.azure.account.key.{account}.dfs.core.windows.net": key}


def options_from_connection_string(text: str | None = None) -> dict[str, str]:
    """The same from a store's connection string; without one, from AZURE_STORAGE_CONNECTION_STRING."""
    text = text or os.environ.get("AZURE_STORAGE_CONNECTION_STRING")
    if not text:
        raise OSError("a connection string is needed: as an argument or in AZURE_STORAGE_CONNECTION_STRING")
    parts = dict(x.split("=", 1) for x in text.split(";") if "=" in x)
    return storage_options(parts.get("AccountName", ""), parts.get("AccountKey", ""))


def read_pages(files: DataFrame, parse, schema: str = "page_idx int, raw_text string") -> DataFrame:
    """pdf_id, page_idx, page_number, raw_text, text, n_chars of the pages of files (path, content).

    parse(content) yields (page_idx, raw_text) for each page; it runs on the executors, a file at a time.
    """

    def run(batches):
        import pandas as pd

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                rows = list(parse(content))
                if rows:
                    yield pd.DataFrame({"pdf_id": path, "page_idx": [r[0] for r in rows], "raw_text": [r[1] for r in rows]})

    found = bounded(files).select("path", "content").mapInPandas(run, f"pdf_id string, {schema}")
    return found.withColumn("page_number", F.col("page_idx") + 1).withColumn("text", strip(F.coalesce("raw_text", F.lit("")))).withColumn("n_chars", F.length("text"))
