import __spark_entry__ as entry
from helpers import DATA, same

from pageloom.llm import queries


def test_ten_queries_and_the_pipeline():
    names = entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert set(queries.QUERIES) < set(names) and "pipeline" in names
    assert set(queries.ORACLE_SQL) < set(entry.oracle_sql())


def test_sql_of_the_deduplicators_and_the_index(spark, duck):
    for name in ("op1_substring_dedup", "op2_decontamination", "op9_near_dedup"):
        same(queries.QUERIES[name](spark, DATA), duck, queries.ORACLE_SQL[name])
