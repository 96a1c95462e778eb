"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every node of ``edges`` (columns a, b, same ordered type): root is the least node reachable.

    Every round links each node to its least smaller neighbour, hands that
    neighbour's link on (halving paths), and re-links the other neighbours to it; it ends when every node hangs on a
    node without smaller neighbours. Rounds grow with the logarithm of a
    component's diameter; minima are pre-aggregated, so hubs cost no more than other nodes.
    """
    e = materialize(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        least = e.groupBy("u").agg(F.min("v").alias("p"), F.count(F.lit(1)).alias("n"))
        up = least.select(F.col("u").alias("w"), F.col("p").alias("pp"))
        step = materialize(least.join(up, F.col("p") == F.col("w"), "left").select("u", "p", "n", "pp"))
        if not step.where("n > 1 or pp is not null").take(1):
            return step.select(F.col("u").alias("id"), F.col("p").alias("root"))
        kept = step.select("u", F.coalesce("pp", "p").alias("v"))
        parent = step.select(F.col("u").alias("w"), "p").where("n > 1")
        handed = e.join(parent, F.col("u") == F.col("w")).where("v != p").select(F.col("v").alias("u"), F.col("p").alias("v"))
        e = materialize(kept.union(handed).distinct())
