"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.stage import staged


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over the edges (u, v).

    Each round is two grouped minima joined back to the edges, never a node's
    neighbours in one row. Nodes without edges have no row; an empty table gives
    an empty result.
    """
    e = staged(edges.where("u is not null and v is not null and u <> v").select("u", "v").distinct(), "edges")
    before = _state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        e = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        e = down.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        e = staged(e.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        after = _state(e)
        if after == before:
            break
        before = after
    members = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
