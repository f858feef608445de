"""Connected components as a distributed fixed point on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .ranges import split_join


def _star_round(edges: DataFrame) -> DataFrame:
    """One round: every node's larger, then smaller neighbours move to its least neighbour.

    Edges meet their node's least neighbour in a join that cuts nodes by their edge count.
    """
    total = edges.count()
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    degree = F.count(F.lit(1)).alias("degree")
    least = both.groupBy("u").agg(F.min("v").alias("m"), degree).select("u", F.least("u", "m").alias("m"), "degree")
    large = split_join(both, least, ["u"], "degree", 2 * total).filter(F.col("v") > F.col("u"))
    large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"), degree)
    moved = split_join(large, least, ["u"], "degree", total).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = least.select("u", F.col("m").alias("v"))
    return moved.union(kept).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one parent at most and no parent has one."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    seen = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.agg(F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0] == 0


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component): the least id of each node's component, for the nodes of some edge.

    Edges are undirected; loops, repeats and rows with a null end add nothing. Alternates
    large-star and small-star rounds, each written to the scratch folder, until the edges
    are stars, whose centers are the least ids as v < u in every edge: about log(n) rounds.
    The driver sees one count per round.
    """
    ends = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    current = stored(ends.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    while not _are_stars(current):
        current = stored(_star_round(current), "stars")
    return current.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
