"""Minimum spanning forests of edge tables by Boruvka rounds, and single linkage of points in the plane over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import release, written


def _roots(picks: DataFrame) -> DataFrame:
    """(c, root) of components that picked each other (c, other): picks under one total order of edges lead into pairs that
    picked one another, whose smaller is the root; pointers double until all have arrived."""
    back = picks.select(F.col("c").alias("other"), F.col("other").alias("_back"))
    parent = F.when((F.col("_back") == F.col("c")) & (F.col("c") < F.col("other")), F.col("c")).otherwise(F.col("other"))
    now = written(picks.select("c", "other").join(back, "other").select("c", parent.alias("root")), "roots")
    while True:
        up = now.select(F.col("c").alias("root"), F.col("root").alias("_up"))
        new = written(now.join(up, "root").select("c", F.col("_up").alias("root"), (F.col("root") != F.col("_up")).alias("moved")), "roots")
        moved = not new.where("moved").isEmpty()
        release(now)
        now = new.drop("moved")
        now._scratch = new.__dict__.pop("_scratch")
        if not moved:
            return now


def spanning_forest(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The minimum spanning forest of ``edges`` (a, b, w): its edges (a, b, w), and (node, root) for every node of an edge.

    In a round each component picks its smallest edge, by weight and then by its ends; components that picked each other join,
    and of the edges between two components the smallest goes on. Rounds halve the components at least. Every step is an
    aggregation with partial minima or an equi-join of written tables.
    """
    now = written(edges.where("a != b").select("a", "b", "w", F.col("a").alias("ca"), F.col("b").alias("cb")), "edges")
    labels = written(now.select(F.col("a").alias("node")).union(now.select("b")).distinct().withColumn("root", F.col("node")), "labels")
    taken = None
    edge = F.struct("w", "a", "b", "ca", "cb").alias("e")
    while not now.isEmpty():
        ends = now.select(F.col("ca").alias("c"), edge).union(now.select(F.col("cb").alias("c"), edge))
        best = ends.groupBy("c").agg(F.min("e").alias("e"))
        picks = written(best.select("c", F.when(F.col("e.ca") == F.col("c"), F.col("e.cb")).otherwise(F.col("e.ca")).alias("other"), F.col("e.a").alias("a"), F.col("e.b").alias("b"), F.col("e.w").alias("w")), "picks")
        chosen = picks.select("a", "b", "w").distinct()
        taken = chosen if taken is None else taken.union(chosen)
        roots = _roots(picks)
        moved = labels.join(roots.select(F.col("c").alias("root"), F.col("root").alias("_new")), "root", "left")
        new_labels = written(moved.select("node", F.coalesce("_new", "root").alias("root")), "labels")
        led = now
        for side in ("ca", "cb"):
            led = led.join(roots.select(F.col("c").alias(side), F.col("root").alias(f"_{side}")), side)
        between = led.where("_ca != _cb").groupBy(F.least("_ca", "_cb").alias("ca"), F.greatest("_ca", "_cb").alias("cb")).agg(F.min(F.struct("w", "a", "b")).alias("e"))
        after = written(between.select("e.a", "e.b", "e.w", "ca", "cb"), "edges")
        release(now, labels, roots)
        now, labels = after, new_labels
    empty = now.select("a", "b", "w")
    return (empty if taken is None else written(taken, "forest")), labels


def neighbours(points: DataFrame, by: list[str], side: float) -> DataFrame:
    """(a, b, ra, rb, w): the pairs of points of different roots within ``side``, each once."""
    square = {f"s{c}": F.floor(F.col(c) / side).cast("bigint") for c in "xy"}
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    left = points.withColumns(square).withColumn("_s", F.explode(steps))
    left = left.select(*by, F.col("node").alias("a"), F.col("root").alias("ra"), F.col("x").alias("ax"), F.col("y").alias("ay"), (F.col("sx") + F.col("_s.i")).alias("sx"), (F.col("sy") + F.col("_s.j")).alias("sy"))
    right = points.withColumns(square).select(*by, F.col("node").alias("b"), F.col("root").alias("rb"), F.col("x").alias("bx"), F.col("y").alias("by_"), "sx", "sy")
    w = F.sqrt(((F.col("ax") - F.col("bx")) * (F.col("ax") - F.col("bx")) + (F.col("ay") - F.col("by_")) * (F.col("ay") - F.col("by_"))).cast("double"))
    return left.join(right, [*by, "sx", "sy"]).where(F.col("ra") > F.col("rb")).select("a", "b", "ra", "rb", w.alias("w")).where(F.col("w") <= side)


def linkage(points: DataFrame, by: list[str], across: float) -> DataFrame:
    """(*by, a, b, w): the merges of single linkage of the points (x, y) of each group: the components of the edges (a, b) up to a
    length w are the clusters at that height. Points are whole numbers; a point is named by the struct (*by, y, x), and no two
    of a group are further apart than ``across``.

    Points meet in squares whose side grows fourfold from 2 on, until every group is one component. A larger side takes the
    shortest way between each two components alone, and of their points only those that have a neighbour missing among the
    eight around them: the ends of a shortest way are such points. So the work goes with the points at first, and with the
    outlines of components that are apart then.
    """
    own = written(points.select(*by, "x", "y").distinct().withColumn("node", F.struct(*by, "y", "x")).withColumn("root", F.col("node")), "points")
    side, merges = 2.0, None
    while True:
        pairs = written(neighbours(own, by, side), "pairs")
        forest, labels = spanning_forest(pairs.groupBy("ra", "rb").agg(F.min("w").alias("w")).withColumnsRenamed({"ra": "a", "rb": "b"}))
        merges = forest if merges is None else merges.union(forest)
        moved = own.withColumnRenamed("root", "_was").join(labels.select(F.col("node").alias("_was"), "root"), "_was", "left").select(*by, "x", "y", "node", F.coalesce("root", "_was").alias("root"))
        if side == 2.0:
            beside = pairs.where("w < 1.5")
            inner = beside.select(F.col("a").alias("node")).unionAll(beside.select("b")).groupBy("node").count().where("count = 8")
            moved = moved.join(inner.select("node"), "node", "left_anti")
        new = written(moved, "points")
        release(own, pairs, labels)
        own = new
        if side > across or own.groupBy(*by).agg((F.min("root") != F.max("root")).alias("several")).where("several").isEmpty():
            release(own)
            return merges.select(*(F.col(f"a.{k}").alias(k) for k in by), "a", "b", "w")
        side *= 4
