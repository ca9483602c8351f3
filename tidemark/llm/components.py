"""Connected components of links, as joins and aggregations over the links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import write_through


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of a link; component is its smallest reachable node.

    Each round hangs every node's neighbours on the smallest of them (large star),
    then joins what is left below each node to its smallest (small star). A round
    ends in a written table, so a lost executor costs one round at most. Rounds
    grow with the logarithm of the longest chain; no node gathers its neighbours,
    all is minima combined per task. Null ends and loops are ignored.
    """
    edges = (
        links.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .filter("u IS NOT NULL AND v IS NOT NULL AND u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    edges = write_through(edges, "links")
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, as is ``down``: the joins with them can then be split at a root that very many nodes hang on.
        lowest = write_through(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "lowest")
        large = (
            both.filter("v > u")
            .join(lowest, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(lowest.filter("m < u").select("u", F.col("m").alias("v")))
            .distinct()
        )
        large = write_through(large, "large-star")
        down = write_through(large.groupBy("u").agg(F.min("v").alias("m")), "down")
        small = (
            large.join(down, "u")
            .filter("v > m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(down.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = write_through(small, "small-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        roots.distinct()
    )
