"""Connected components of links between 64-bit nodes, by stars that grow and shrink in turns."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailtax.functions.staging import cut


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for all nodes but the smallest ones; arrays of any integer type."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[: len(u)], at[len(u):]
    label = np.arange(len(nodes))
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(label, jumped := label[label]):
            label = jumped
    rest = label != np.arange(len(nodes))
    return nodes[rest], nodes[label[rest]]


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on their smallest one; ``large``: only those above the node.

    The smallest neighbours are stored first, so that adaptive execution can split a hot node's links.
    """
    both = links if not large else links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = cut(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")))
    joined = both.join(least, "u")
    moved = joined.where(F.col("v") > F.col("u") if large else F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:  # the node itself hangs on the smallest one too
        moved = moved.union(least.select("u", F.col("m").alias("v")))
    return cut(moved.where("u <> v").distinct())


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every linked node; the root is the component's smallest node.

    ``links``: columns u, v (long), any direction, repeats and loops allowed. Each round stores its links, so lost
    executors repeat one round at most; a round's rows never exceed the links it got. Empty in, empty out.
    """
    links = cut(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    while True:
        grown = _star(links, large=True)
        small = _star(grown, large=False)
        # a forest of stars: every upper node has one link and no root is an upper node
        state = small.agg(F.count("*").alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("h")).first()
        before = links.agg(F.count("*").alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("h")).first()
        links = small
        if state == before:
            break
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
