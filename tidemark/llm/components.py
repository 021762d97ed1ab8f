"""Connected components of a graph that is only ever a distributed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; component is the smallest node reachable.

    Rounds of star contraction: a node's larger neighbours move to its smallest neighbour, then
    its smaller ones do, until nothing changes (about log^2 of the longest path). Each round is
    two grouped minima, which combine before the shuffle, and joins that adaptive execution can
    split at a hub; it is written to the shared folder, so a lost executor costs one round.
    Edges may repeat, in either direction; loops give a component of one. No edges: no rows.
    """
    state = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "components"
    )
    mark = None
    while True:
        both = state.select("u", "v").union(state.select(F.col("v"), F.col("u")))
        low = both.groupBy(F.col("u").alias("_c")).agg(F.min("v").alias("m"))
        low = low.select("_c", F.least("_c", "m").alias("m"))
        up = both.where("v >= u").join(low, both["u"] == low["_c"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = up.union(state.where("u = v").select("u", "v")).distinct()
        least = large.groupBy(F.col("u").alias("_c")).agg(F.min("v").alias("m"))
        down = large.join(least, large["u"] == least["_c"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
        state = materialize(
            down.union(least.select(F.col("_c").alias("u"), F.col("m").alias("v"))).distinct(), "components"
        )
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return state.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
        mark = now
