"""Connected components on Spark by alternating large-star and small-star rounds.

Every round is a partial-aggregated minimum per node and one join; each is checkpointed into the
shared folder, so a lost executor costs one round at most.  No node's neighbours meet in one task:
minima are pre-aggregated and the joins on hot nodes can be split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import cut_lineage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): smallest node reachable, for every node of ``edges`` (two long columns).

    Self links and repeated or reversed links are harmless; null ends are ignored; no edges give an
    empty result.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    e = edges.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"), F.isnull(x).alias("n1"), F.isnull(y).alias("n2"))
    e = cut_lineage(e.where("not n1 and not n2").select("u", "v"))
    state = None
    while True:
        # large-star: every neighbour above a node moves to the node's smallest neighbour (itself included)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        e = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            e.where("u = v"))
        # small-star: a node and its smaller neighbours move to the smallest of them
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct()
        e = cut_lineage(e)
        now = e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if tuple(now) == state:
            return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
        state = tuple(now)
