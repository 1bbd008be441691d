"""Connected components of an edge frame by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deltaloom.storage import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """Frame (node, component) for all nodes of ``edges`` (a, b); a component is named by its smallest node.

    Each step hangs neighbours on the smallest node around; edges never grow in number, and the loop ends when a step changes nothing, that is
    when every node hangs on its component's smallest node. Minima are combined before the shuffle, so a hub with many edges is no single task.
    """
    stars = cut_lineage(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).where("v <> m").distinct(), "edges")
    before = None
    while True:
        stars = cut_lineage(_small(_large(stars)), "stars")
        now = tuple(stars.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "m")), F.sum(F.pmod(F.xxhash64("m", "v"), F.lit(1 << 30)))).first())
        if now == before:
            break
        before = now
    roots = stars.select(F.col("m").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return stars.select(F.col("v").alias("node"), F.col("m").alias("component")).unionByName(roots)


def _large(e: DataFrame) -> DataFrame:
    """Each node's larger neighbours hang on the smallest node among its neighbours and itself."""
    both = e.select(F.col("v").alias("u"), F.col("m").alias("w")).unionByName(e.select(F.col("m").alias("u"), F.col("v").alias("w")))
    least = both.groupBy("u").agg(F.min("w").alias("least")).select(F.col("u").alias("of"), F.least("u", "least").alias("least"))
    return both.where("w > u").join(least, F.col("u") == F.col("of")).select(F.col("w").alias("v"), F.col("least").alias("m")).distinct()


def _small(e: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours hang on the smallest of them."""
    least = e.groupBy("v").agg(F.min("m").alias("least")).select(F.col("v").alias("of"), "least")
    moved = e.join(least, F.col("v") == F.col("of"))
    hung = moved.select(F.col("m").alias("v"), F.col("least").alias("m")).unionByName(least.select(F.col("of").alias("v"), F.col("least").alias("m")))
    return hung.where("v <> m").distinct()
