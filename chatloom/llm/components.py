"""Connected components by alternating large and small stars; nothing of the graph reaches the driver but its size and a checksum.

What is left of a graph when it has at most ``FEW`` edges is solved in one task, by the same rule: the smallest node names the component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.frames import cut, released

FEW = 200_000  # edges


def _large(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node it knows."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every node that has an edge to another, with the smallest node of its component (itself is left out).

    ``edges`` has two long columns; loops and repeats are ignored. The number of rounds grows with the logarithm of the longest path.
    """
    a, b = edges.columns
    now = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now, before = cut(now), None
    while True:
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or state[0] == 0:
            return now
        if state[0] <= FEW:
            return cut(now.coalesce(1).mapInPandas(released(_solved), "u long, v long"))
        before = state
        now = cut(_small(_large(now)))


def _solved(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All edges at once: nodes take the smallest name among their neighbours' until none changes, names jumping to the names of names."""
    edges = pd.concat([*parts])
    nodes, ends = np.unique(edges[["u", "v"]].to_numpy(), return_inverse=True)
    a, b = ends.reshape(-1, 2).T
    name = np.arange(len(nodes))
    while True:
        least = np.minimum(name[a], name[b])
        after = name.copy()
        # the roots of both ends hear of the smaller root
        np.minimum.at(after, name[a], least)
        np.minimum.at(after, name[b], least)
        while (jumped := after[after]).tobytes() != after.tobytes():
            after = jumped
        if (after == name).all():
            break
        name = after
    own = name != np.arange(len(nodes))
    yield pd.DataFrame({"u": nodes[own], "v": nodes[name[own]]})


def forest(pairs: np.ndarray) -> list[tuple[int, int]]:
    """Of (i, j) pairs, those that first join two trees."""
    parent: dict[int, int] = {}

    def root(i: int) -> int:
        while parent.setdefault(i, i) != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for i, j in pairs.tolist():
        a, b = root(i), root(j)
        if a != b:
            parent[a] = b
            out.append((i, j))
    return out
