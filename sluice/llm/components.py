"""Connected components over an edge table, by large-star / small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """One star round over (u, v) with u > v."""
    both = edges if small else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if small:  # every smaller neighbour, and u itself, hangs below the least one
        out = joined.select(F.explode(F.array(F.col("u"), F.col("v"))).alias("u"), F.col("m").alias("v"))
    else:  # every larger neighbour hangs below the least one
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter("u <> v").distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every end of an edge; component is the least node reached.

    Nulls and loops are left out. Each round's edges are written to the shared folder, so a lost executor
    costs at most a round; the driver sees one sum a round.
    """
    edges = (edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
             .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    edges, before = cut(edges, "edges"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before or not state[0]:
            break
        before = tuple(state)
        edges = cut(_stars(_stars(edges, small=False), small=True), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
