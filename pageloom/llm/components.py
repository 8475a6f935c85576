"""Connected components of a graph that no machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, saved


def _are_stars(df: DataFrame) -> bool:
    """Whether each node of the links (a, b), a > b, is either the centre of its links or has just one."""
    ends = df.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(df.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.agg(F.max((F.col("up") + F.col("down") > 1).cast("int")).alias("no")).first().no


def connected_components(edges: DataFrame, src: str, dst: str, rounds: int = 60) -> DataFrame:
    """node long, component long (the least node of the component), written to the shared folder, for each node that has an edge to another.

    Alternating large-star and small-star steps: in turn each node links its larger neighbours, then its smaller ones
    and itself, to the least node around it, until all links are stars.  The number of rounds grows with the logarithm
    of the graph; links that are stars as they come take none.  A node with many neighbours is a hot key of joins only, whose partitions Spark can split; the minima
    are aggregated before the shuffle, and written, so that both sides of each join are plain exchanges.  Each round is written to the shared folder, which cuts the lineage.  Loops,
    repeated and null edges count for nothing.
    """
    a, b = F.greatest(src, dst), F.least(src, dst)  # a > b always
    now = edges.select(F.col(src).cast("long").alias(src), F.col(dst).cast("long").alias(dst)).where(F.col(src) != F.col(dst)).select(a.alias("a"), b.alias("b")).distinct()
    now = saved(now)
    for _ in range(rounds):
        if _are_stars(now):
            break
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near = saved(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = saved(large)
        least = saved(large.groupBy("a").agg(F.min("b").alias("m")))
        joined = large.join(least, "a")
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b"))).distinct()
        old, now = now, saved(small)
        for done in (near, large, least, old):
            forget(done)
    else:
        raise RuntimeError(f"the components did not settle in {rounds} rounds")
    out = saved(now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
    forget(now)
    return out
