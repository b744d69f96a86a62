"""Connected components of a graph of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tapeglass.llm.common import staged


def _stars(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Links every neighbour to the smallest of its neighbourhood.

    both_ways: neighbours greater than the vertex go to its smallest neighbour or itself (large star); else the
    vertex and its smaller neighbours do (small star). Minima are combined before the shuffle, and the join back
    to the links can be split by Spark where a vertex has very many.
    """
    if both_ways:
        links = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = links.join(least, "a")
    if both_ways:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) of every vertex of the links (a, b), longs; the component is its smallest vertex.

    Each step is written to the shared scratch folder, so that plans stay short and a lost executor repeats one
    step. The links stand several times in a step's plan: two steps in one plan would multiply, and the driver holds and
    plans that plan anew after each of its stages. The number of rounds grows with the logarithm of the graph. No links
    give no rows.
    """
    now = staged(edges.where(F.col("a") != F.col("b")).distinct(), "links")
    before = None
    while True:
        print_ = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if print_ == before:
            break
        before = print_
        now = staged(_stars(staged(_stars(now, True), "large-stars"), False), "links")
    roots = now.select(F.col("b").alias("vertex")).distinct()
    return now.select(F.col("a").alias("vertex"), F.col("b").alias("component")).union(
        roots.select("vertex", F.col("vertex").alias("component"))
    )
