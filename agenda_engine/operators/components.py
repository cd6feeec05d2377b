"""Connected components of an edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agenda_engine.functions.durable import cut, scratch


def _with_smallest(edges: DataFrame) -> DataFrame:
    """The edges with m, the smallest neighbour of u or u itself. Rows and aggregate share one shuffle."""
    dealt = edges.where("u is not null and v is not null").repartition("u")  # what a join would ask of one side only parts the shuffles
    return dealt.join(dealt.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m")), "u")


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))


def _settled(now: DataFrame) -> bool:
    """Whether every node hangs on one smaller node and carries none, or carries only: one row for each node that is not the smallest."""
    ends = now.select(F.inline(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))))
    each = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return each.where("up > 1 or (up > 0 and down > 0)").agg(F.count(F.lit(1))).first()[0] == 0


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each node of an edge reaches.

    A round hangs larger neighbours, and then smaller ones, on the smallest neighbour, so long chains shorten
    by a factor; each round is a table in the shared folder, and the last one stays. Edges that are settled cost no round:
    the driver keeps each statement's plan and tasks for its status, so a round is one small statement of three shuffles.
    """
    with scratch(edges.sparkSession) as keep:
        now = cut(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
        done = 0
        while not _settled(now):
            if done == rounds:
                raise RuntimeError(f"components did not settle in {rounds} rounds")
            # m is at most u: a condition on both sides stays above the join, so that the two sides stay one shuffle
            large = _with_smallest(_both_ways(now)).where(F.col("v") > F.greatest("u", "m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            small = _with_smallest(large).select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))))
            now = cut(small.where("u > v").distinct())
            done += 1
        return keep(now.select(F.col("u").alias("node"), F.col("v").alias("component")))
