"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .common import cut_lineage

MOST_ROUNDS = 50


def connected_components(edges: DataFrame, within: Sequence[str], a: str, b: str) -> DataFrame:
    """(within, node, component): undirected components, each named by its smallest node.

    Each round gives a node the least label among its neighbours, then that label's own
    label, so chains halve.  A round is two shuffles of labels and is checkpointed; the
    driver sees only whether anything changed.  Raises if it does not settle in
    ``MOST_ROUNDS``.  Null ends of edges are left out; no edges give no rows."""
    keys = list(within)
    e = edges.select(*keys, F.col(a).alias("x"), F.col(b).alias("y")).dropna()
    e = cut_lineage(e.unionByName(e.select(*keys, F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    labels = cut_lineage(e.groupBy(*keys, "x").agg(F.least(F.col("x"), F.min("y")).alias("l")))
    for _ in range(MOST_ROUNDS):
        near = e.join(labels.withColumnRenamed("x", "y"), [*keys, "y"]).groupBy(*keys, "x").agg(F.min("l").alias("n"))
        step = labels.join(near, [*keys, "x"]).select(*keys, "x", F.col("l").alias("was"), F.least("l", "n").alias("l"))
        jump = step.select(*keys, F.col("x").alias("l"), F.col("l").alias("j"))
        new = cut_lineage(step.join(jump, [*keys, "l"], "left").select(*keys, "x", "was", F.least("l", F.coalesce("j", "l")).alias("l")))
        changed = new.filter(F.col("was") != F.col("l")).limit(1).count()
        labels = new.drop("was")
        if not changed:
            return labels.select(*keys, F.col("x").alias("node"), F.col("l").alias("component"))
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
