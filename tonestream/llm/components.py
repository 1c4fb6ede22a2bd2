"""Connected components by alternating stars, for edge tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonestream.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that each node of the edges ``a, b`` is connected with.

    Large stars hang every larger neighbour on a node's smallest one, small stars every
    smaller neighbour and the node itself; both keep components and shorten paths, and
    together they reach stars in a few rounds. A node with very many edges is split by the
    aggregation's map side and by the join's skew handling, for which the smallest neighbours are written before they are joined. Edges whose ends are equal are ignored.
    """
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if tuple(state) == before or not state["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = tuple(state)
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "edges")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        own = least.select("u", F.col("m").alias("v"))
        edges = materialize(small.unionAll(own).distinct(), "edges")
