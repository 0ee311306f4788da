"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first())


def large_star(edges: DataFrame) -> DataFrame:
    """Every node connects its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every node connects its smaller neighbours and itself to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
    moved = down.join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge (u, v) but the smallest of its component,
    which is the component's id. Each round is checkpointed in the shared folder."""
    edges = C.checkpointed(edges.filter("u <> v").distinct())
    state = _state(edges)
    while True:
        edges = C.checkpointed(small_star(C.checkpointed(large_star(edges))))
        after = _state(edges)
        if after == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = after
