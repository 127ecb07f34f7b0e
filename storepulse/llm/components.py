"""Connected components of a graph given by its edges.

Alternates two steps until nothing changes: every node links its larger
neighbours to the smallest node it sees, then its smaller neighbours and
itself to the smallest of these.  Both are a grouped minimum (aggregated
before the shuffle) and an equi-join, which adaptive execution splits for a
hub with many edges, so no node's neighbours are gathered in one task and
nothing but a count and a checksum reaches the driver.  Each round is written
to the shared checkpoint folder, which cuts the lineage and lets the job
survive lost executors.  The number of rounds grows with the logarithm of
the largest component.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import checkpointed


class Forest:
    """Components of the rows of one task, as links are found: ``label`` is the first row reachable."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while i.size:
            a, b = label[i], label[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label[:] = up


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that some edge links to another; root is the smallest node reachable.

    Null ends, loops and repeated edges are left out.  No edges: no rows.
    """
    e = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e = checkpointed(e)
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        e, before = checkpointed(small), state
        state = _state(e)
        if state == before:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
