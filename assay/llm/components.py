"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _turned(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(u, v) pairs to (u, v) with v the smallest node that u reaches, for every u but that node.

    Large-star and small-star steps by turns until nothing changes. Every step is a minimum per
    node, which is pre-aggregated and written, and a join with that table: adaptive execution can
    split the join of a node with very many neighbours, as it could not below the aggregate itself.
    Each round is a written table. Edges with a null end and loops are no links, repeated edges are
    one, and no edges give no rows.
    """
    edges = stage(edges.where("u <> v").distinct(), "edges")
    seen = None
    while True:
        both = _turned(edges)
        least = stage(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "edges-least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"),
                                                            F.col("m").alias("v")).distinct()
        large = stage(large, "edges-large")
        low = stage(large.groupBy("u").agg(F.min("v").alias("m")), "edges-low")
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
            .alias("e")).select("e.*").where("u <> v").distinct()
        edges = stage(small, "edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            return edges
        seen = now
