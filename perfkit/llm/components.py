"""Connected components of an undirected edge table, by alternating star contractions.

Each round links every vertex to the least vertex of its neighbourhood (large star: larger
neighbours only; small star: smaller ones), which halves path lengths; rounds are written to the
shared folder. Neighbourhoods are never collected: a vertex's least neighbour is a partially
aggregated minimum, written and joined back to the edges, where the engine can split a vertex
with very many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfkit.llm.common import stored


def _least(edges: DataFrame) -> DataFrame:
    """(u, v) with v < u: every vertex's least linked vertex."""
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) of orderable ids -> (u, root): the least id each linked vertex reaches.

    Null ids and self links are ignored; an empty table gives an empty table; repeated links
    change nothing.
    """
    e = (edges.where(F.col("u") != F.col("v"))
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = stored(e, "edges")
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.min("v").alias("x")).select("u", F.least("u", "x").alias("m"))
        near = stored(near, "nearest")
        large = (both.join(near, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = stored(large, "large-star")
        down = stored(_least(large), "least")
        small = (large.join(down, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(down.withColumnRenamed("m", "v"))).distinct()
        small = stored(small, "small-star")
        if small.join(e, ["u", "v"], "left_anti").isEmpty() and e.join(small, ["u", "v"], "left_anti").isEmpty():
            return small.select("u", F.col("v").alias("root"))
        e = small
