"""Connected components of a graph too large for one machine.

Large-star and small-star steps: each node's neighbours are hung under
the smallest of them, until nothing changes. Every step is a grouped minimum and a
join, written to the shared folder; the rounds grow with the logarithm of a
component's size, not with its diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoengine.llm.common import save


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: each node's larger neighbours under the least of its
    neighbourhood. Small: each node and its smaller neighbours under the least."""
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    hung = near.join(least, "u")
    if large:
        out = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def forest(edges: DataFrame) -> DataFrame:
    """(u, v): each node of ``edges`` (a, b) that is not its component's least
    node, with that node."""
    now = save(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        now = save(_star(_star(now, True), False), "star")
        new = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if new == state:
            return now
        state = new


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, component) of ``nodes`` (id, label): the least label of the nodes
    that ``edges`` (a, b) connect."""
    roots = forest(edges).select(F.col("u").alias("id"), F.col("v").alias("root"))
    placed = nodes.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = placed.groupBy("root").agg(F.min("label").alias("component"))
    return placed.join(least, "root").select("id", "component")
