"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.llm import scratch


def connected(edges: DataFrame) -> DataFrame:
    """``id, component`` of every node of ``edges (a, b)``; a component is named by its least id.

    Large-star hangs each node's larger neighbours on the least node it knows; small-star hangs its
    smaller neighbours and itself there. Both only ever take a minimum per node, so no neighbourhood
    is gathered in a task, and the round's edges are written to the shared folder. The rounds end
    when a round changes nothing, after about the logarithm of the longest path. Loops, repeated
    and null edges are ignored; without edges the result is empty.
    """
    spark = edges.sparkSession
    path, state = _store(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        now = scratch.read(spark, path)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("w"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("w").alias("v")).distinct()
        root = large.groupBy("u").agg(F.min("v").alias("w"))
        small = large.join(root, "u").select(F.explode(F.array(F.struct("u", "w"), F.struct(F.col("v").alias("u"), "w"))).alias("e")).select("e.u", F.col("e.w").alias("v")).where("u <> v").distinct()
        new_path, new_state = _store(small)
        scratch.delete(spark, path)
        if new_state == state:
            break
        path, state = new_path, new_state
    stars = scratch.read(spark, new_path)
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(stars.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _store(edges: DataFrame) -> tuple[str, tuple]:
    """Written edges, with their number and an order-free sum of their hashes."""
    path = scratch.write(edges, "component-edges")
    row = scratch.read(edges.sparkSession, path).agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20)"))).first()
    return path, tuple(row)
