"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.blocks import freed_shuffles, written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for each node that has an edge.

    Every round points all larger neighbours of a node at the smallest node around it
    (large star) and then all smaller ones (small star), until nothing changes; the
    rounds grow with the logarithm of the longest path. A round shuffles edges, with
    minima combined before the shuffle; the join that brings a minimum to a node's
    edges has one row a node on one side, so that a hot node is split by adaptive
    skew handling. Nulls and loops are dropped; an empty table gives an empty table.
    """
    pairs = edges.select(
        F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")
    ).where(F.col("hi") > F.col("lo")).distinct()
    pairs = written(pairs, "edges")
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).select(
            F.col("hi").alias("u"), F.least("m", "hi").alias("m")
        )
        # large star: (v, m) for the neighbours v > u; the edges that hold them have lo = u
        large = pairs.join(least, F.col("lo") == F.col("u")).select("hi", F.col("m").alias("lo")).distinct()
        # small star: every node's smaller neighbours, and the node itself, point at the smallest
        low = large.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("u"), "m")
        moved = large.join(low, F.col("hi") == F.col("u")).select("hi", "lo", "m")
        small = moved.select(F.explode(F.array(
            F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")),
            F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
        )).alias("e")).select("e.hi", "e.lo").where("hi > lo").distinct()
        pairs = written(small, "edges")
        with freed_shuffles(pairs.sparkSession):
            now = pairs.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return pairs.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("component")).unionByName(
        pairs.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )
