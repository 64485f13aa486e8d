"""Distributed connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.base import cut


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``edges`` (a, b) -> (node, root): every node of an edge between different nodes, with the smallest
    node of its component. Null ends, loops and repeated edges are ignored.

    Each round joins the edges with the smallest neighbour of each node, twice; only a count and a hash
    reach the driver. The smallest neighbour is a partial aggregate and its table has one row for a key,
    so a hub with very many edges is only on the side that AQE's skew join splits. Edges are checkpointed
    each round: the plan stays short and a lost executor doesn't restart the loop.
    """
    e = cut(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
            .where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct())
    seen = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()  # every edge points from the larger node to the smaller
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = cut(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        now = e.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())


def units(members: DataFrame, key: list[str], salt: str, size: int) -> DataFrame:
    """Split buckets of any size into work units of at most about ``2 * size`` rows.

    ``members`` has one row per (key, member). Buckets of one row are dropped (no pair). A bucket of n
    rows is cut into ``ceil(n / size)`` chunks by the hash of ``salt``; each unordered pair of chunks
    (lo, hi) is a unit, so that every pair of rows meets and no task ever holds a whole hot bucket.
    Adds ``chunk``, ``lo``, ``hi``.
    """
    n = members.groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1")
    k = F.ceil(F.col("_n") / F.lit(size)).cast("int")
    return (members.join(n, key)
            .withColumn("chunk", F.pmod(F.xxhash64(F.lit(7), salt), k).cast("int"))
            .withColumn("_other", F.explode(F.sequence(F.lit(0), k - 1)))
            .withColumn("lo", F.least("chunk", "_other")).withColumn("hi", F.greatest("chunk", "_other"))
            .drop("_n", "_other"))
