"""Connected components of a large edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import store


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """One star operation: neighbours of a node are linked to the least node around it.

    The large star moves larger neighbours and keeps nothing else, the small star moves
    smaller ones and the node itself. Minima are combined before the shuffle; the join
    back is split by adaptive execution when a node has very many neighbours.
    """
    if larger:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.union(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) links to (node, component): the least node that each node can reach.

    Nodes without links are not in the result. Large and small stars alternate until
    nothing changes; each round is written to the shared scratch folder.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = store(edges, "links")
    seen = None
    while True:
        edges = store(_stars(_stars(edges, True), False), "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select("v", "v")).distinct()
        seen = state
