"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsieve.llm.common import staged


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of a link: the smallest node it reaches.

    Links are `a`, `b` of one integer type, in any order and number; loops and
    links with a null end join nothing. Each round hangs every node under the
    smallest of its neighbours (large star, then small star) until the links
    form one star per component: O(log n) rounds, each a table in the shared
    scratch folder. A hub of many links is an ordinary join key whose rows
    Spark's skew join can split; its minimum is combined map-side. Nothing
    but two numbers per round reaches the driver.
    """
    links = edges.select(F.greatest(a, b).alias("x"), F.least(a, b).alias("y")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    )
    links, mark = _settled(links.distinct())
    while mark[0]:
        both = links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m"))
        large = both.join(least, "x").where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        large = staged(large.distinct(), "large-star")
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(low, "x").where("y != m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        links, now = _settled(small.unionByName(low.select("x", F.col("m").alias("y"))).distinct())
        if now == mark:
            break
        mark = now
    ends = links.select(F.col("x").alias("node"), F.col("y").alias("component"))
    return ends.unionByName(links.select(F.col("y").alias("node"), F.col("y").alias("component")).distinct())


def _settled(links: DataFrame) -> tuple[DataFrame, tuple]:
    table = staged(links, "links")
    row = table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
    return table, tuple(row)


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 linked by (i, j): the smallest node each one reaches."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        while not np.array_equal(nxt := root[root], root):
            root = nxt
        open_ = root[i] != root[j]
        i, j = i[open_], j[open_]
    return root
