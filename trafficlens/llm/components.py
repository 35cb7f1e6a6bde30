"""Connected components of a distributed graph."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlens.session import staged

MAX_ROUNDS = 60


def _star(edges: DataFrame) -> DataFrame:
    """Hang the larger neighbours of every node on the node's smallest neighbour."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
    return (
        both.filter("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("root").alias("b"))
        .filter("a <> b")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them; ``a > b`` holds."""
    least = edges.groupBy("a").agg(F.min("b").alias("root"))
    below = edges.join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return below.union(least.select("a", F.col("root").alias("b"))).filter("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (smallest node reachable) for the nodes of edges (``a``, ``b``).

    Alternating stars: every round is two aggregations with map-side combine
    and joins whose hubs adaptive execution may split; what is written between
    rounds is at most one row per edge, and lineage ends there.  Self loops,
    nulls and repeated edges are harmless; no edges give no rows.
    """
    kind = edges.schema["a"].dataType
    now = staged(
        edges.filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").cast(kind).alias("a"), F.least("a", "b").cast(kind).alias("b"))
        .distinct(),
        "links",
    )
    mark = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    before = now.agg(mark.alias("m")).first()["m"]
    for _ in range(MAX_ROUNDS):
        now = staged(_small_star(_star(now).distinct()).distinct(), "links")
        after = now.agg(mark.alias("m")).first()["m"]
        if after == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select("b", "b").distinct()
            )
        before = after
    raise RuntimeError("components did not settle")


def group_roots(near: np.ndarray) -> np.ndarray:
    """For each node of a small symmetric adjacency matrix its group's first node."""
    n = len(near)
    label = np.arange(n)
    while True:
        best = np.minimum(label, np.where(near, label[None, :], n).min(axis=1, initial=n))
        best = best[best]
        if (best == label).all():
            return label
        label = best
