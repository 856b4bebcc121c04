"""Connected components of links, by joins and groups alone.

Each round points every node to the smallest neighbour it has seen (large star) and then every
pair of neighbours to the smaller one's target (small star), until nothing changes.  A round
keeps at most as many links as the one before, and the rounds grow with the logarithm of the
longest chain, not with its length.  A node with very many neighbours is no problem: the only
thing kept of them is their minimum, which is computed before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root``, the smallest node that it reaches, for each node with a link."""
    edges = stored(
        links.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
        edges = stored(_small_star(_large_star(edges)), "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest of its neighbours and itself."""
    both = edges.union(edges.select("v", "u"))
    # stored, so that the join reads two plain shuffles and Spark can split a hub's neighbours
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = edges.join(least, "u")
    return (
        moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .union(least.select("u", F.col("m").alias("v")))
        .distinct()
    )
