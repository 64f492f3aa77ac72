"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a grouped minimum and a join, so no neighbourhood is ever gathered.
Every round is written to the shared folder, which cuts the lineage.
"""

from pyspark.sql import DataFrame, functions as F

from ratelake.session import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over ``u, v``; gives pairs with ``u > v``."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if large:
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = both.where(F.col("v") < F.col("u"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return moved.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node that each node of an edge (``u, v``) reaches."""
    now = stage(edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
        now = stage(_star(_star(now, True), False), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
