"""Connected components of an edge table, without collecting any part of it.

Alternating large-star and small-star steps.  Each step is a grouped minimum,
which combines before its shuffle, and an equi-join whose skewed side Spark may
split, so a vertex with a third of all edges is no bottleneck.  The tables of
each round are checkpointed in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40))).first()
    return row[0], row[1] or 0


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for each node of ``edges(u, v)``; the smallest node names the component.

    Self-links, repeated links and either direction are allowed; null ends are
    ignored.  An empty table gives an empty result.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    e = cut(e)
    before = _state(e)
    if not before[0]:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(most_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        e = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = e.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*").filter("u <> v").distinct()
        e = cut(e)
        now = _state(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
