"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stage_at
from shelfmark.session import fresh_dir
from shelfmark.sources.storage import drop


def _point_to_smallest(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Every node's neighbours linked to the smallest of them and the node itself.

    With ``larger_only`` only neighbours above the node move (the "large star"), which never undoes a link;
    otherwise the edges have to point downwards and all of a node's lower neighbours move ("small star").
    """
    smallest = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    met = edges.join(smallest, "u")
    if larger_only:
        moved = met.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = met.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            smallest.select("u", F.col("m").alias("v"))
        )
    return moved.filter("u <> v").distinct()


def smallest_reachable(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``: the smallest node that chains of links reach.

    Two star steps take turns until nothing moves; the number of rounds grows with the logarithm of the longest
    chain. A node with very many links is reduced to its smallest neighbour before the shuffle, and its links are
    joined, not gathered. Each round is written to the shared folder, and the one before it dropped.
    """
    spark = links.sparkSession
    path = fresh_dir(spark, "components")
    edges = stage_at(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        path,
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        stars = _point_to_smallest(both, larger_only=True)
        old, path = path, fresh_dir(spark, "components")
        edges = stage_at(_point_to_smallest(stars, larger_only=False), path)
        drop(spark, old)
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v"), F.col("v")).distinct()
            )
        before = state
