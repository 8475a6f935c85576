import collections

import pytest
from helpers import DATA, same

from pageloom.llm import queries
from pageloom.llm.sharding import assign_shards, lookup_table, write_shards

NAMES = [f"s{i}" for i in range(7)]


def test_table_is_even_and_moves_little():
    full = lookup_table(NAMES, 1009)
    sizes = collections.Counter(full).values()
    assert len(full) == 1009 and max(sizes) - min(sizes) <= 1
    fewer = lookup_table(NAMES[:-1], 1009)
    stay = sum(a == b for a, b in zip(full, fewer, strict=True) if a != 6)
    assert stay > 0.8 * sum(a != 6 for a in full)


@pytest.mark.parametrize("shards,size", [([], 7), (["a", "a"], 7), (["a", "b"], 9), (NAMES, 5), (["a"], 1)])
def test_bad_parameters(shards, size):
    with pytest.raises(ValueError):
        lookup_table(shards, size)


def test_rows(spark, docs):
    df = docs([(1, "a"), (1, "a"), (None, None), (2, "")], _slot="x", _owner="y").withColumnRenamed("_owner", "owner").withColumnRenamed("_slot", "s")
    out = assign_shards(df, ["doc_id"], NAMES, 1009).collect()
    assert len(out) == 4 and len({r.shard for r in out if r.doc_id == 1}) == 1 and all(r.shard in NAMES for r in out)
    assert assign_shards(df.limit(0), ["doc_id"], NAMES, 1009).count() == 0
    assert assign_shards(df, ["doc_id", "text"], ["only"], 2).select("shard").distinct().count() == 1
    with pytest.raises(ValueError):
        assign_shards(df.withColumnRenamed("s", "slot"), ["doc_id"], NAMES, 1009)


def test_no_python_in_the_plan(spark):
    plan = queries.op10_sharding(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not any(x in plan for x in ("Python", "Arrow", "ExistingRDD"))


def test_write(spark, docs, tmp_path):
    write_shards(docs([(i, "x") for i in range(200)]), ["doc_id"], NAMES, 1009, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("_shard").count().count() == 7


def test_query(spark, duck):
    same(queries.op10_sharding(spark, DATA), duck, queries.ORACLE_SQL["op10_sharding"])
