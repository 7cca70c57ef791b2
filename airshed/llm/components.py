"""Connected components of an edge table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import forget, written


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours become neighbours of the least one around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours become neighbours of the least of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    return (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())


def components(edges: DataFrame) -> DataFrame:
    """``edges``: u, v (long; repeated, reversed and self edges allowed). Returns node and
    component (its smallest node) for every node that is not the smallest of its own.

    Alternates large and small stars until the edges no longer change, a number of rounds that grows
    with the logarithm of the nodes. Minima are summed up before they are shuffled, and a
    hot node's edges meet its minimum in an equi-join that adaptive execution can split.
    """
    now = written(edges.filter("u <> v").select("u", "v").distinct(), "edges")
    size = now.count()
    while True:
        last, before = now, size
        now = written(_small_star(_large_star(last)), "edges")
        size = now.count()
        same = size == before and now.join(last, ["u", "v"], "left_anti").isEmpty()
        forget(last)
        if same:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
