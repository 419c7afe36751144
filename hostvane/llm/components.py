"""Connected components of a graph too large for one machine, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostvane.llm.shared import stored


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first())


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("node").agg(F.min("root").alias("low"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (node, root: long) but the roots; root is the smallest node reachable.

    A node's neighbours are only ever joined with their minimum, one row per node, so a hub is split like any skewed
    join side. Every round is written to the shared folder. An empty edge table gives an empty result.
    """
    now = stored(edges.where("node <> root").select(F.greatest("node", "root").alias("node"), F.least("node", "root").alias("root")).distinct(), "edges")
    before = None
    while (digest := _digest(now)) != before:
        before = digest
        both = now.unionByName(now.select(F.col("root").alias("node"), F.col("node").alias("root")))
        low = _lowest(both).withColumn("low", F.least("node", "low"))
        large = both.where("root > node").join(low, "node").select(F.col("root").alias("node"), F.col("low").alias("root")).distinct()
        low = _lowest(large)
        small = large.join(low, "node").select(F.col("root").alias("node"), F.col("low").alias("root")).where("node <> root")
        now = stored(small.unionByName(low.select("node", F.col("low").alias("root"))).distinct(), "edges")
    return now
