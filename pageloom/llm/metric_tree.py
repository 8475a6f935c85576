"""Exact top-k by inner product with metric trees.

With one more component, sqrt(M - |x|^2) for M the largest squared length of a block, all vectors lie on a sphere, and
the distance to a query (with 0 there) falls as the inner product grows: d^2 = |q|^2 + M - 2 q.x.  So the nearest are
the highest-scoring.  A tree has pages of entries: inner entries hold a routing vector, its distance to the page's own
routing vector, a covering radius and a child page; leaf entries hold a vector and its distance to the page's routing
vector.  The search takes pages from a heap by the least distance that they can hold, and computes no distance that the
triangle inequality over the stored distances rules out.  Scores are exact integers; bounds are compared with slack, and
of equal scores a page that holds no smaller id is left out.

Vectors are dealt to blocks, and a tree is built for each once and stored with its pages.  A query first searches one
tree; the least score of its best there bounds the search of all other trees, whose root pages then rule out what they
can.  Queries meet trees in blocks, each query once a tree; each query's best of all trees are ranked.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, saved

#: Entries of a page, at most.
PAGE = 256
#: Vectors of one tree and queries of one group, about.
TREE, QUERIES = 8192, 2048


@dataclass
class Page:
    ids: np.ndarray | None  # leaf: ids in ascending order
    points: np.ndarray  # on the sphere: of the entries, or of the children's routing vectors
    parent: np.ndarray  # distances to this page's routing vector
    radii: np.ndarray | None = None
    children: list[Page] | None = None
    least_id: np.ndarray | None = None  # of each child
    vectors: np.ndarray | None = None  # leaf: as integers


def _distance(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((points - centre) ** 2).sum(1), 0))


class MetricTree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE, seed: int = 1):
        """vectors: integers as float64, or Python integers where products may not be exact as such."""
        self.page, self.rng, self.exact = page, np.random.default_rng(seed), vectors.dtype == object
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        lengths = (vectors * vectors).sum(1)
        self.m = max(lengths) if len(lengths) else 0
        rest = np.array([math.sqrt(self.m - x) for x in lengths])
        points = np.column_stack((vectors.astype(np.float64), rest))
        self.slack = 1e-9 * (1 + math.sqrt(self.m)) * 4
        self.root = self._build(ids, vectors, points, points[0]) if len(ids) else None

    def _build(self, ids: np.ndarray, vectors: np.ndarray, points: np.ndarray, centre: np.ndarray) -> Page:
        if len(ids) <= self.page:
            return Page(ids, points, _distance(points, centre), vectors=vectors)
        n = min(self.page, -(-len(ids) // self.page) * 2)
        routing = points[np.sort(self.rng.choice(len(ids), n, replace=False))]
        norms = (points**2).sum(1)[:, None] + (routing**2).sum(1)[None]
        near = (norms - 2 * points @ routing.T).argmin(1)
        groups = [np.flatnonzero(near == k) for k in range(n)]
        groups = [g for g in groups if len(g)]
        if max(map(len, groups)) > 0.9 * len(ids):  # many alike: cut by id
            groups = np.array_split(np.arange(len(ids)), n)
        at = [points[g[len(g) // 2]] if (near[g] != near[g[0]]).any() else routing[near[g[0]]] for g in groups]
        children = [self._build(ids[g], vectors[g], points[g], c) for g, c in zip(groups, at, strict=True)]
        radii = np.array([_distance(points[g], c).max() for g, c in zip(groups, at, strict=True)])
        return Page(None, np.array(at), _distance(np.array(at), centre), radii, children, np.array([ids[g[0]] for g in groups]))

    def search(self, query: np.ndarray, k: int, floor: int | None = None) -> list[tuple[int, int]]:
        """The k highest (score, id): by falling score, then by rising id.  floor: scores below it need not be found."""
        if self.root is None:
            return []
        q2, q = (query * query).sum(), np.append(query.astype(np.float64), 0.0)
        base = float(q2 + self.m)
        best: list[tuple] = []  # a heap of (score, -id)
        heap: list[tuple] = [(0.0, -1, 0, self.root, None)]
        tick = 0

        def reach(more: int) -> float:
            """The distance within which a score of the worst of the best, and so much more, lies."""
            worst = best[0][0] + more if len(best) == k else floor
            return math.inf if worst is None else math.sqrt(max(0.0, base - 2.0 * float(worst if floor is None else max(worst, floor)))) + self.slack

        while heap:
            bound, least, _, page, centre = heapq.heappop(heap)
            if bound > reach(0):
                break
            if len(best) == k and bound > reach(1) and least > -best[0][1]:
                continue  # equals at most, and of larger ids
            limit = reach(0)
            open_ = np.flatnonzero(np.abs(centre - page.parent) - (0 if page.radii is None else page.radii) <= limit) if centre is not None else np.arange(len(page.parent))
            if page.children is None:
                scores = page.vectors[open_] @ query
                if len(best) == k:
                    take = scores >= best[0][0]
                    open_, scores = open_[take], scores[take]
                for s, i in zip(scores.tolist(), page.ids[open_].tolist(), strict=True):
                    if len(best) < k:
                        heapq.heappush(best, (int(s), -i))
                    elif (int(s), -i) > best[0]:
                        heapq.heapreplace(best, (int(s), -i))
                continue
            d = _distance(page.points[open_], q)
            lower = np.maximum(d - page.radii[open_], 0) - self.slack
            for e, low, dist in zip(open_.tolist(), lower.tolist(), d.tolist(), strict=True):
                if low <= limit:
                    tick += 1
                    heapq.heappush(heap, (low, int(page.least_id[e]), tick, page.children[e], dist))
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """id long, v array<long>: floor(scale * x) of each component; without null ids and vectors that are null, empty, or
    hold a null or a number that is not finite.  Every row counts, repeated ones as often as they stand."""
    x = F.transform(F.col(f"`{vector_col}`"), lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: F.coalesce((F.abs(c) < float("inf")) & ~F.isnan(c), F.lit(False)))
    v = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    rows = df.where(F.col(f"`{id_col}`").isNotNull() & (F.size(vector_col) > 0)).where(fine)
    return rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v"))


def _matrix(vectors: pa.Array, n: int) -> np.ndarray:
    """Integers as float64 where their products are exact as such, else as Python integers."""
    out = vectors.flatten().to_numpy().reshape(n, -1)
    big = max(abs(int(out.max())), abs(int(out.min()))) if out.size else 0
    return out.astype(np.float64) if big * big * max(1, out.shape[1]) < 2**52 else out.astype(object)


def _trees(blocks: DataFrame) -> DataFrame:
    """dim, block, tree binary: the tree of each block's vectors (id, v, dim, block)."""

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        v = _matrix(rows["v"].combine_chunks(), rows.num_rows)
        tree = MetricTree(rows["id"].to_numpy(), v)
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int64()), "tree": pa.array([pickle.dumps(tree, 5)], pa.binary())})

    return blocks.groupBy("dim", "block").applyInArrow(build, "dim int, block long, tree binary")


def _asked(queries: DataFrame) -> DataFrame:
    """dim, part, n, asked binary: some queries (no, id, v, dim, part, floor, block) together."""

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        packed = (rows["no"].to_pylist(), rows["id"].to_pylist(), _matrix(rows["v"].combine_chunks(), rows.num_rows), rows["floor"].to_pylist(), rows["block"].to_pylist())
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int64()), "asked": pa.array([pickle.dumps(packed, 5)], pa.binary())})

    return queries.groupBy("dim", "part").applyInArrow(pack, "dim int, part long, asked binary")


def _searched(pairs: DataFrame, k: int, first: bool) -> DataFrame:
    """no, query_id, vec_id, score, own: the k best of each tree (block, tree) for the queries beside it (asked).

    first: of queries whose first block it is; else of all others, as far as they reach the floor.  own: whether it may
    be the query's own row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tree = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                here = (batch["dim"][i].as_py(), batch["block"][i].as_py())
                if here != last:
                    last, tree = here, pickle.loads(batch["tree"][i].as_py())
                out: list[tuple[int, int, int, int, int]] = []
                for no, own, q, floor, at in zip(*pickle.loads(batch["asked"][i].as_py()), strict=True):
                    if (at == here[1]) != first:
                        continue
                    if (q.dtype == object) != tree.exact:
                        q = q if q.dtype == object else q.astype(np.int64).astype(object)
                    itself = int((q * q).sum())
                    out += [(no, own, j, s, j == own and s == itself) for s, j in tree.search(q, k, floor) if floor is None or s >= floor]
                if out:
                    columns = [pa.array([x[c] for x in out], pa.int64()) for c in range(4)]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([x[4] for x in out], pa.bool_())], ["no", "query_id", "vec_id", "score", "own"])

    return pairs.select("dim", "block", "tree", "asked").mapInArrow(run, "no long, query_id long, vec_id long, score long, own boolean")


def top_k(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: for each query, which is a row of candidates, the k other rows of the highest inner
    product, fewer if there are fewer; equals by the smaller id.  Both sides as quantised() has them.

    Every row is a candidate: rows that repeat an id and a vector come back as often, and a query's row is left out once.
    A query that stands in two rows is asked twice.  Rows are dealt to trees by their number, so that no hot id or vector
    makes a large one.  Vectors meet those of the same number of components only.  Empty tables give an empty result.  A
    score beyond 64 bits raises an error.
    """
    number = F.monotonically_increasing_id()
    held = saved(candidates.select("id", "v", F.size("v").alias("dim"), number.alias("no")))
    asked = saved(queries.select("id", "v", F.size("v").alias("dim"), number.alias("no")))
    n_trees, parts = max(1, -(-held.count() // TREE)), max(1, -(-asked.count() // QUERIES))
    block = F.pmod(F.xxhash64("no", F.lit(17)), F.lit(n_trees))
    trees = saved(_trees(held.withColumn("block", block)))
    dealt = asked.withColumn("block", block)  # of a query, the tree that it searches first
    share = F.pmod(F.xxhash64("no", F.lit(5)), F.lit(max(1, -(-parts // n_trees))))  # beyond one group for each tree
    opening = _asked(dealt.withColumns({"floor": F.lit(None).cast("long"), "part": F.col("block") + share * n_trees})).withColumn("block", F.col("part") % n_trees)
    near = saved(_searched(trees.join(opening.drop("part"), ["dim", "block"]), k + 1, True))
    every, blocks, far = near, None, None
    if n_trees > 1:
        # The score that k + 1 rows of the first tree reach, the own one perhaps among them, bounds the k others.
        bounds = near.groupBy("no").agg(F.min("score").alias("floor"), F.count("*").alias("c")).where(F.col("c") == k + 1).select("no", "floor")
        packed = _asked(dealt.join(bounds, "no", "left").withColumn("part", F.pmod(F.xxhash64("no"), F.lit(parts))))
        blocks = saved(packed)
        every_tree = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_trees - 1).cast("long")))
        far = saved(_searched(trees.join(blocks.withColumn("block", every_tree), ["dim", "block"]), k + 1, False))
        every = near.unionAll(far)
    one = F.row_number().over(Window.partitionBy("no", "own").orderBy("score"))
    others = every.withColumn("_n", one).where(~(F.col("own") & (F.col("_n") == 1)))
    rank = F.row_number().over(Window.partitionBy("no").orderBy(F.desc("score"), "vec_id"))
    out = saved(others.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
    for done in (held, asked, trees, near, blocks, far):
        forget(done)
    return out


__all__ = ["MetricTree", "quantised", "top_k"]
