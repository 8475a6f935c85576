import os

from pageloom.llm import common as c


def test_saved_and_forgotten(spark):
    df = c.saved(spark.range(5).selectExpr("id", "CAST(NULL AS STRING) AS x"))
    path = df._saved_at.removeprefix("file:")
    assert df._saved_at.startswith(c.shared_dir(spark)) and os.path.isdir(path) and df.count() == 5
    c.forget(df)
    c.forget(spark.range(1))
    c.forget(None)
    assert not os.path.exists(path)


def test_a_given_checkpoint_folder_is_used(spark):
    at = spark.sparkContext.getCheckpointDir() or c.shared_dir(spark)
    assert c.shared_dir(spark).rstrip("/") in (at.rstrip("/"), spark.conf.get("spark.checkpoint.dir", "").rstrip("/"))


def test_batches_are_only_made_smaller(spark):
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    before = [spark.conf.get(k) for k in keys]
    try:
        spark.conf.set(keys[0], "10000")
        spark.conf.set(keys[1], "1000")
        c.bounded_batches(spark.range(1))
        assert [spark.conf.get(k).rstrip("b") for k in keys] == [str(c.BATCH_ROWS), "1000"]
        spark.conf.set(keys[0], "0")  # no bound at all
        c.bounded_batches(spark.range(1))
        assert spark.conf.get(keys[0]) == str(c.BATCH_ROWS)
    finally:
        for k, v in zip(keys, before, strict=True):
            spark.conf.set(k, v)
