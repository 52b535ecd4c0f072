"""Connected components of a graph that only Spark holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm.common import written
from reelspark.operators.spread import lookup_join


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that a link (a, b) names; the root is the smallest
    node of its component.

    Large stars and small stars take turns: a node's larger neighbours move to its
    smallest neighbour, then its smaller ones do. The rounds needed grow with the
    logarithm of the longest chain. A star with very many leaves is no hot spot: minima
    are pre-aggregated, and the joins back to them can be split.
    """
    u, v = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = written(links.where("a <> b").select(u, v).distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edges.select("v", "u"))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = lookup_join(both, least, ["x"]).where("y > x").select(F.col("y").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = lookup_join(large, low, ["u"])
        moved = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(moved.union(low).distinct(), "edges")
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select("v", F.col("v").alias("w")).distinct()
    )
