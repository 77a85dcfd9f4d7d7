"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import staged


# places in which a node's links meet its minimum
SPREAD = 8


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b: longs); root is the smallest node reachable.

    Large star and small star in turn: each node's neighbours are tied to the
    smallest of them, until nothing changes. A hub's links are aggregated to a
    minimum, task by task first, and meet it again in ``SPREAD`` places; the
    links of each round are a written table.
    """
    def ties(edges):
        low = edges.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("low", "a"))
        spread = low.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        return edges.withColumn("part", F.pmod(F.xxhash64("b"), F.lit(SPREAD)).cast("int")).join(spread, ["a", "part"]).drop("part")

    def both(edges):
        return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def large(edges):
        return ties(both(edges)).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()

    def small(edges):
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        found = ties(down)
        return found.select("b", "low").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            found.select("a", F.col("low").alias("b"))).distinct()

    def state(edges):
        return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).head()

    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = state(edges)
    for _ in range(rounds):
        if before[0] == 0:
            break
        edges = staged(small(large(edges)), "links")
        after = state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"no fixed point after {rounds} rounds")
    # a star now: every node but a root has one link, to its root
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
