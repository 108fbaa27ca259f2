"""Connected components of a graph that is a table of edges: large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's component. ``edges`` has columns a, b; a node in no edge has no row.

    Every round is a written table. Nothing but two sums comes to the driver, to see when a round changes nothing.
    """
    stars = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark, center = _mark(stars), Window.partitionBy("u")
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.withColumn("m", F.least("u", F.min("v").over(center))).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Edges to the smallest from the node itself and from its other neighbours; the smallest has none to itself.
        small = large.withColumn("m", F.min("v").over(center)).select("m", F.explode(F.array("u", "v")).alias("u"))
        stars = materialize(small.where("u <> m").select("u", F.col("m").alias("v")).distinct(), "edges")
        before, mark = mark, _mark(stars)
        if mark == before:
            break
    roots = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
