"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import durable


def component_roots(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)`` (long ids), one root per component.

    Each round hooks every node to the neighbour that is smallest in a
    round-specific hash order and contracts the edges, so the graph shrinks by
    a constant factor on average, whatever its shape (a chain in id order
    included).  Sums per node are pre-aggregated map-side, contracted edges
    are deduplicated, and every round is checkpointed.  The maps of the rounds
    are composed from the last one back; no edge or label reaches the driver.
    """
    edges = durable(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .distinct())
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        turn = len(maps)
        both = edges.union(edges.select("b", "a")).toDF("node", "other")
        rank = F.struct(F.xxhash64(F.col("other"), F.lit(turn)).alias("h"), F.col("other").alias("v"))
        mine = F.struct(F.xxhash64(F.col("node"), F.lit(turn)).alias("h"), F.col("node").alias("v"))
        to = durable(both.groupBy("node").agg(F.min(rank).alias("m"))
                     .select("node", F.least(F.col("m"), mine)["v"].alias("to")))
        left, right = to.toDF("a", "ra"), to.toDF("b", "rb")
        edges = durable(edges.join(left, "a").join(right, "b").where("ra != rb")
                        .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
        maps.append(to)
    if not maps:
        return edges.selectExpr("a as node", "b as root")
    out = maps.pop()
    while maps:
        later = out.toDF("to", "root")
        out = durable(maps.pop().join(later, "to", "left").select("node", F.coalesce("root", "to").alias("root")))
    return out.toDF("node", "root")
