"""Connected components as DataFrame joins (alternating large and small stars).

No edge list, component or label ever reaches the driver: every round is two
grouped minima joined back to the edges, cut with a checkpoint in the shared
folder, and compared with the round before by one aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (both.join(least, "a").filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return linked.unionByName(own).filter("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; component = smallest node reachable.

    Edges with a NULL end and loops are ignored; repeated edges count once.
    Nodes without an edge are not in the result (they are their own component).
    """
    now = cut(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct())
    before = None
    state = _state(now)
    while state[0] and state != before:
        before = state
        now = cut(_small_star(_large_star(now)))
        state = _state(now)
    return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
