"""Graph operators: connected components by alternating star contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import discard, materialize


def connected_components(edges: DataFrame, src: str = "a", dst: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges``; component is the smallest node that can be reached.

    Large-star and small-star steps (Kiveris et al., 2014) alternate until the edge set stands still: the
    number of rounds grows with the logarithm of a component's size, each step is one partial aggregate and
    one equi-join that AQE can split at a hub, and nothing is gathered on the driver but two numbers a round.
    A step's minima are a written table, so that the join has a shuffle of its own on either side and AQE can split a hub's edges; every step is
    written too, so that the plan stays short. Null ends and loops are ignored.
    """
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null and u <> v")
    current = materialize(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        state = tuple(current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen or not state[0]:
            break
        seen = state
        for step in (_large_star, _small_star):
            after, minima = step(current)
            after = materialize(after, "edges")
            discard(current)
            discard(minima)
            current = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` nodes reaches over the links a-b: what a task answers with instead of all its links."""
    label = np.arange(n)
    while len(a) and (label[a] != label[b]).any():
        low = np.minimum(label[a], label[b])
        for ends in (label[a], label[b]):
            np.minimum.at(label, ends, low)
        while (label[label] != label).any():
            label = label[label]
    return label


def _large_star(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each node links its larger neighbours to the smallest node of its neighbourhood. Also returns the minima."""
    both = e.union(e.select(F.col("v"), F.col("u"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
    least = materialize(least, "minima")
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")), least


def _small_star(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each node links its smaller neighbours, and itself, to the smallest of them. Also returns the minima."""
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    least = materialize(down.groupBy("u").agg(F.min("v").alias("m")), "minima")
    pairs = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return pairs.union(least.select("u", F.col("m").alias("v"))).distinct(), least
