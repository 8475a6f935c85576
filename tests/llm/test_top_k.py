import math
import random

import numpy as np
from helpers import DATA, same

from pageloom.llm import metric_tree, queries
from pageloom.llm.metric_tree import MetricTree, quantised, top_k


def brute(rows, asked, k, scale=1024):
    fine = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(fine):
        if asked(i):
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for m, (j, v) in enumerate(fine) if m != n and len(v) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)]
    return sorted(out)


def vectors(spark, rows):
    return quantised(spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, label int").repartition(3), "vec_id", "embedding", 1024)


def ours(df, asked, k):
    return sorted(map(tuple, top_k(df.where(asked), df, k).select("query_id", "rank", "vec_id", "score").collect()))


def test_trees_against_brute_force():
    rng = np.random.default_rng(2)
    for n, d, spread in ((3000, 8, 50), (500, 3, 2), (1, 4, 9), (700, 2, 0)):
        v = rng.integers(-spread, spread + 1, (n, d)).astype(float)
        ids = rng.permutation(n * 2)[:n]
        tree = MetricTree(ids, v, page=16)
        for q in v[:40]:
            want = sorted(((int(s), -int(i)) for s, i in zip(v @ q, ids, strict=True)), reverse=True)[:7]
            assert tree.search(q, 7) == [(s, -i) for s, i in want]
            floor = want[-1][0]
            assert [x for x in tree.search(q, 7, floor) if x[0] >= floor] == [(s, -i) for s, i in want]


def test_bounds_save_distances(monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1000, (40, 6))
    v = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(0, 5, (4000, 6)))
    tree, seen = MetricTree(np.arange(4000), v), []
    plain = metric_tree._distance
    monkeypatch.setattr(metric_tree, "_distance", lambda p, c: seen.append(len(p)) or plain(p, c))
    for q in v[:20]:
        tree.search(q, 5)
    assert sum(seen) < 20 * 4000 / 10


def test_bad_vectors_ties_and_sizes(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, None), (6, [1.0, None]), (7, [3.0, 1.0, 1.0]), (10, [-0.0004, 0.5]), (1, [1.0, 2.0]), (None, [9.0, 9.0]), (8, []), (20, [-1.0, -2.0])]
    assert ours(vectors(spark, rows), "id % 10 = 0", 3) == brute(rows, lambda i: i % 10 == 0, 3)


def test_every_row_is_a_candidate(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (10, [2.0, 2.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0]), (3, [0.5, 1.0]), (10, [0.0, 1.0])]
    assert ours(vectors(spark, rows), "id % 10 = 0", 4) == brute(rows, lambda i: i % 10 == 0, 4)


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(2**20 + i), float(2**21 - 3 * i)]) for i in range(12)]
    assert ours(vectors(spark, rows), "id % 5 = 0", 4) == brute(rows, lambda i: i % 5 == 0, 4)


def test_many_blocks_and_a_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(metric_tree, "TREE", 40)
    monkeypatch.setattr(metric_tree, "QUERIES", 7)
    rnd = random.Random(1)
    rows = [(i, [0.5, 0.25, -1.0] if i % 3 else [rnd.uniform(-1, 1) for _ in range(3)]) for i in range(300)]
    rows += [(40, [0.25, 0.25, -0.5])] * 120  # a hot id
    assert ours(vectors(spark, rows), "id % 20 = 0", 10) == brute(rows, lambda i: i % 20 == 0, 10)


def test_empty(spark):
    assert ours(vectors(spark, []), "id % 10 = 0", 3) == []
    assert ours(vectors(spark, [(0, [1.0])]), "id % 10 = 0", 3) == []


def test_query(spark, duck):
    same(queries.op5_top_k(spark, DATA), duck, queries.ORACLE_SQL["op5_top_k"])
