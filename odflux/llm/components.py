"""Connected components of a large table of links, and of a small array of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflux.llm.place import stored


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(high, low))")).first())


def components(links: DataFrame) -> DataFrame:
    """node and component (its least node), for all nodes of ``links`` (a, b) but the least ones.

    Links are turned in rounds into stars around the least node: every node hands
    its higher neighbours, then its lower ones, to the least node it knows. The
    number of rounds grows with the logarithm of the longest path. Each round is
    written to the shared folder. Links of a node to itself do not count.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct()
    edges = stored(edges, "links")
    mark = _mark(edges)
    while True:
        both = edges.union(edges.select("low", "high")).toDF("node", "other")
        least = both.groupBy("node").agg(F.least("node", F.min("other")).alias("to"))
        large = both.where("other > node").join(least, "node").where("other != to").select(F.col("other").alias("high"), F.col("to").alias("low"))
        large = large.distinct()
        least = large.groupBy("high").agg(F.min("low").alias("to"))
        small = large.join(least, "high").where("low != to").select(F.col("low").alias("high"), F.col("to").alias("low"))
        edges = stored(small.union(least.toDF("high", "low")).distinct(), "stars")
        before, mark = mark, _mark(edges)
        if mark == before:
            return edges.select(F.col("high").alias("node"), F.col("low").alias("component"))


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least node of the component of each of n nodes under the links a to b."""
    root = np.arange(n)
    while True:
        to = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, to)
        np.minimum.at(new, b, to)
        np.minimum.at(new, root[a], to)
        np.minimum.at(new, root[b], to)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new
