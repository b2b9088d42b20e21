"""Connected components of a graph given as edges, by alternating large and small stars.

Every round moves only minima along edges: no neighbour list is ever gathered. A round's edges
go to the checkpoint folder, so lost executors cost no more than the round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusdeck.llm.shared import BROADCAST_BYTES, attach, cut

#: At most two arcs for each edge, of two numbers each.
ROW_BYTES = 64


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def _star(arcs: DataFrame, take: Column, few: bool) -> DataFrame:
    """For arcs (u, v): v and the least of u and all its v, for the arcs that ``take`` picks.

    The least are broadcast if the arcs are few; else nodes with many arcs are split.
    """
    least = arcs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count("*").alias("n"))
    if few:
        return arcs.join(F.broadcast(least.drop("n")), "u").filter(take)
    return attach(arcs, cut(least), "u", "n").filter(take)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges ``(a, b)``: root is the least node reachable.

    Loops, repeated and reversed edges are allowed; no edges give no rows.
    """
    current = cut(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while (now := _state(current)) != before and now[0]:
        before = now
        few = now[0] * ROW_BYTES <= BROADCAST_BYTES
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            current.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = _star(both, F.col("v") > F.col("u"), few).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = large if few else cut(large)
        least = _star(large, F.lit(True), few)
        small = least.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
        current = cut(small.filter("a != b").distinct())
    roots = current.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
