"""Connected components: a local forest inside a task, stars across tasks."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm._common import stage


def forest(n: int, pairs: Iterable) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges (node, root) of the graph of ``pairs``, arrays (x, y) at a time."""
    root = np.arange(n)
    for x, y in pairs:
        while True:
            a, b = root[x], root[y]
            apart = a != b
            if not apart.any():
                break
            x, y = x[apart], y[apart]
            lo, hi = np.minimum(a[apart], b[apart]), np.maximum(a[apart], b[apart])
            np.minimum.at(root, hi, lo)
            while True:                        # halve the paths until flat
                up = root[root]
                if (up == root).all():
                    break
                root = up
    node = np.flatnonzero(root != np.arange(n))
    return node, root[node]


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (u, v): comp is the smallest node
    connected with it. Alternates large and small stars; each round is an
    aggregation and a join on a written table, so no node's neighbours are
    gathered in a row, and a node of high degree is a skewed join side that can
    be split. Ends when the links no longer change (rounds ~ log of the longest
    chain)."""
    e = stage(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
              "links")

    def sign(df):
        r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    state = sign(e)
    while state[0]:
        # large star: every larger neighbour of a node goes to the node's smallest neighbour
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        big = stage(big.filter("u <> v").distinct(), "large")
        # small star: smaller neighbours, and the node itself, go to the smallest of them
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stage(small.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "links")
        now = sign(e)
        if now == state:
            break
        state = now
    tops = e.groupBy("u").agg(F.min("v").alias("comp")).select(F.col("u").alias("node"), "comp")
    return tops.unionByName(tops.select(F.col("comp").alias("node"), "comp").distinct())
