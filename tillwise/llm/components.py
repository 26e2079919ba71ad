"""Connected components of links between numbered documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.staging import stage


def components(links: DataFrame) -> DataFrame:
    """``node, label`` from links ``a, b``: the smallest node of each linked set.

    Every node takes the smallest of its neighbours, first for its larger neighbours and
    then for its smaller ones, until nothing changes. Minima are aggregated before they are
    joined back, so a node with very many links is no single group. Every step is a written
    table.
    """
    both = links.where("a <> b").select("a", "b")
    edges = stage(both.union(both.select("b", "a")).distinct().toDF("u", "v"), "links")
    while True:
        # larger neighbours of u hear of the smallest around u
        least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = edges.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # u and its smaller neighbours do so, too
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        small = stage(small, "links")
        # a star forest: every node has one smaller neighbour, which has none itself
        roots = small.select(F.col("v").alias("u")).distinct()
        if (
            not small.join(roots, "u", "left_semi").limit(1).count()
            and not small.groupBy("u").count().where("count > 1").limit(1).count()
        ):
            return small.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
                roots.select("u", F.col("u").alias("v"))
            )
        edges = small.union(small.select("v", "u")).toDF("u", "v")
