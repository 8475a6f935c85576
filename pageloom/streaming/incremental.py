"""Files as they arrive.  A file comes whole in one batch, so grouping needs no state across batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.grouping import manifest
from ..operators.signals import with_text_signals


def watch_pages(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A stream of page tables that are written to a folder as Parquet."""
    return spark.readStream.schema(schema).parquet(folder)


def split_stream(pages: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str):
    """Starts a query that gives each batch's manifest to sink(manifest, batch); all files there are, then it ends.

    Windows that are not over time can't run on a stream, so they run on each batch.  sink may see a batch twice and
    should overwrite by its number.
    """

    def each(batch: DataFrame, number: int) -> None:
        sink(manifest(with_text_signals(batch)), number)

    return pages.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
