"""Connected components by alternating star contraction, as joins and partial aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """node and label (the least node of its component) for every node of `edges` (a, b).

    Large stars hang a node's greater neighbours on its least neighbour, small stars its smaller ones; a node
    keeps one edge for each neighbour it hands on, so the edges never outgrow the input. Each round is written to
    the shared folder. The rounds grow with the logarithm of the largest component.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        else:
            both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        out = both.join(least, "u")
        if large:
            return out.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        hung = out.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return hung.filter("a != b").distinct()

    e = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    mark = None
    for _ in range(most):
        e = materialize(star(star(e, True), False), "stars")
        # the same number of edges and the same sums of hashes: nothing moved
        new = tuple(e.agg(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(38, 0)))")).first())
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
