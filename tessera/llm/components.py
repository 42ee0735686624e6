"""Connected components of an edge table, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(node, comp) for each node of ``edges`` (a, b: long); comp is the component's smallest node.

    Alternates large-star and small-star steps: each points the neighbours of a node at
    the smallest of them, until nothing changes, after about log(nodes) rounds. A step is a
    minimum (aggregated before its shuffle) and a join that can be split at hot nodes. Each
    round is written to the shared folder. Loops, repeated and reversed edges are fine.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    current = scratch.save(both.filter("a <> b"), f"{name}0")
    state, step = None, 0
    while True:
        # Large star: for each node, its larger neighbours are linked to the smallest in its neighbourhood.
        low = current.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = current.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        # Small star: for each node, its smaller neighbours and itself are linked to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select("a", "b", "low")
        down = small.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).union(small.select("a", F.col("low").alias("b"))).distinct()
        step += 1
        links = scratch.save(down, f"{name}{step}links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == now:
            scratch.drop(f"{name}{step - 1}", *([f"{name}{step - 1}links"] if step > 1 else []))
            return links.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(links.select(F.col("b").alias("node"), F.col("b").alias("comp"))).distinct()
        following = scratch.save(links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), f"{name}{step}")
        scratch.drop(f"{name}{step - 1}", *([f"{name}{step - 1}links"] if step > 1 else []))
        state, current = now, following
