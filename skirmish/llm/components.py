"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skirmish.llm.storage import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour greater than a node is hung under the least node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its lesser neighbours are hung under the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge that is not its component's least
    node; the root is that least node. Rounds grow with the logarithm of the
    component size; each is stored, and only a row count and a hash sum per
    round come to the driver. Loops and repeated edges do no harm; null ends
    are ignored."""
    edges = stored(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "star")
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == state or not found[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = found
