"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is an aggregation with partial minima and a join of two written tables, which Spark can split where a node has
very many edges. The number of rounds grows with the logarithm of the longest path; edges that are stars already take none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import release, written


def _stars(edges: DataFrame) -> bool:
    """Whether every node of ``edges`` (u, v), v < u, is the end of one edge alone or the smaller end of all its edges."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("upper"), F.lit(0).alias("lower"))
    ends = ends.unionAll(edges.select(F.col("v").alias("n"), F.lit(0).alias("upper"), F.lit(1).alias("lower")))
    nodes = ends.groupBy("n").agg(F.sum("upper").alias("upper"), F.max("lower").alias("lower"))
    return not nodes.agg(F.bool_or(F.col("upper") + F.col("lower") > 1)).first()[0]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that is not the smallest of its component: the smallest is its name.

    Nulls and edges from a node to itself say nothing; repeated edges count once. No edges give an empty table.
    """
    ends = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = written(ends.distinct(), "edges")
    while not _stars(now):
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = written(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        new = written(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        release(now, least, large, low)
        now = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
