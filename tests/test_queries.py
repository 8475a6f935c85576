import pytest
from helpers import DATA, same

from pageloom.plans.catalog import ORACLE_SQL, QUERIES


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    same(QUERIES[name](spark, DATA), duck, ORACLE_SQL[name])


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_grouping_needs_one_exchange(spark):
    plan = QUERIES["group_pages"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_scan_reads_only_what_is_asked(spark):
    plan = QUERIES["group_pages"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan and "value" not in plan


def test_groups_by_block_are_the_same(spark):
    from pageloom.operators.grouping import with_groups
    from pageloom.plans import inputs

    one = inputs.signals(spark, DATA)
    df = one.withColumn("pdf_id", one.pdf_id % 3).unionByName(one.where("event_id < 500").selectExpr("CAST(NULL AS BIGINT) AS pdf_id", *one.columns[1:]))
    want = sorted(map(repr, with_groups(df).collect()))
    for block in (7, 1000, 10**9):
        assert sorted(map(repr, with_groups(df, block=block).collect())) == want


def test_splitting_by_block_is_the_same(spark):
    from pageloom.operators.grouping import manifest
    from pageloom.operators.legacy import segments
    from pageloom.plans import inputs

    one = inputs.signals(spark, DATA)
    hot = one.withColumn("pdf_id", one.pdf_id % 3)
    pages = inputs.conversations(spark, DATA).selectExpr("CASE WHEN pdf_id % 2 = 0 THEN 'hot' END AS pdf_id", "CAST(pdf_id * 100 + page_idx AS INT) AS page_idx", "CASE WHEN pdf_id % 5 < 2 THEN concat('DOCUMENT 1 OF 2\nBILL OF SALE\n', text) ELSE text END AS text")
    assert pages.select("pdf_id", "page_idx").distinct().count() == pages.count()
    for make, df in ((manifest, hot), (segments, pages)):
        want = sorted(map(repr, make(df).collect()))
        assert len(want) > 20
        for block in (7, 10**9):
            assert sorted(map(repr, make(df, block=block).collect())) == want


def test_running_sums_by_block(spark):
    from pyspark.sql import functions as F

    from pageloom.operators.grouping import running_sum

    df = spark.createDataFrame([("a", 1, 2), ("a", 5, 3), ("a", 9, 4), (None, 4, 1), (None, 12, 1), ("b", None, 7), ("b", 0, 1)], "k string, o long, v int")
    want = [("a", 1, 2), ("a", 5, 5), ("a", 9, 9), ("b", None, 7), ("b", 0, 8), (None, 4, 1), (None, 12, 2)]
    for block in (None, 1, 4, 100):
        rows = running_sum(df, ["k"], "o", F.col("v"), "s", block).select("k", "o", "s").collect()
        assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr), block
    assert running_sum(df.limit(0), ["k"], "o", F.col("v"), "s", 4).count() == 0


@pytest.mark.parametrize("name", ["credit_app_selection", "split_manifest", "legacy_segments", "legacy_starts"])
def test_what_texts_say_is_stored(spark, name):
    """These read the signals of pages several times, so no text may be looked at in their plans."""
    df = QUERIES[name](spark, DATA)
    assert "split(" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.inputFiles() and not [f for f in df.inputFiles() if "documents.parquet" in f]


def test_titles_are_looked_for_once_and_before_windows(spark):
    plan = QUERIES["marker_titles"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_position(") == 1
    rows = plan.splitlines()
    under = rows[next(i for i, row in enumerate(rows) if "Window [" in row) + 1]
    assert "doc_id#" in under and "text#" not in under
