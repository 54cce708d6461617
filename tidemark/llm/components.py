"""Connected components of a link table, as alternating star steps.

Large-star links every larger neighbour of a node to the node's least
neighbour; small-star does so with the smaller ones.  A node's neighbours
are never gathered: each step is a mergeable minimum and an equi-join, so
a node with very many links is split like any skewed join key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link to another; root is the
    least node of its component.  Loops, repeats and NULLs are ignored.
    Every round is written to the shared folder."""
    edges = (links.where(F.col(a) != F.col(b))
             .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    edges = written(edges, "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u")
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                         .alias("e"))
                 .select("e.u", "e.v").where("u > v").distinct())
        edges = written(small, "links")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select("v").distinct()
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root"))))
