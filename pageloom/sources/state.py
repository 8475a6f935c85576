"""State between the steps of a query, as Parquet in a folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting by which the shuffle files of a query are deleted when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Of tables that are read only once their write has returned: no marker file.
PRIVATE = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir.  Where that is unset, a session on one machine gets one of our own under the
    warehouse; on a cluster it is an error, as the warehouse may be a local folder of each host."""
    context = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not at:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
        context.setCheckpointDir(at)
    return at.rstrip("/")


def saved(df: DataFrame) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it again: cuts the lineage, survives lost executors.

    The shuffle files of the write go with its end; nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/saved-{uuid.uuid4().hex}"
    was = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(**PRIVATE).option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, was)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def forget(df: DataFrame | None) -> None:
    """Deletes what saved() wrote."""
    path = getattr(df, "_saved_at", None)
    if path:
        jvm, context = df.sparkSession._jvm, df.sparkSession.sparkContext
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
