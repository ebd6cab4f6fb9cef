"""Connected components of a link table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortscore.session import settle


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node) from links (a, b) of longs.

    Every node of ``links`` is returned, also one that only links to itself;
    links with a null end are ignored. Large-star hangs a node's larger
    neighbours on its smallest, small-star the smaller ones; rounds grow with
    the logarithm of the longest path. Each round is stored in the shared
    folder, which also ends its lineage. Minima are pre-aggregated, so a node
    that everything links to costs one row per task.
    """
    ends = links.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    stored = settle(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    nodes = stored.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    edges, before = stored.where("u <> v"), None
    while True:
        seen = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if seen == before:
            break
        before = seen
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settle(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct())
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
