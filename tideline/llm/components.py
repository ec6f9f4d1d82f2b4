"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, root (the smallest node reachable) for every node of ``links``.

    Each round joins every node's larger neighbours to its smallest one (large star), then its
    smaller ones (small star); both halve long paths, so rounds grow with the logarithm of the
    longest path. A node's minimum is pre-aggregated before the shuffle; a node with very many
    neighbours is split by Spark's skew join. Rounds are cut by a written table. The end is
    reached when a round changes no link, told by a count and a sum of hashes.
    """
    edges = staged(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        # large star: to the smallest of a node and all its neighbours go its larger neighbours
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        # small star: to the smallest of its smaller neighbours go a node and those neighbours
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(least, "u")
        small = near.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    nodes = edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
