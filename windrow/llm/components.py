"""Connected components of a table of links, by large-star and small-star rounds (Kiveris et al. 2014).

Each round links every node to the smallest of its neighbours; rounds end when nothing changes.
Links are a table in the shared folder after each round, so a lost executor costs one round at
most, and none of them ever reaches the driver. A hub's links are aggregated before they move.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.session import run_folder


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: the smallest node reachable, for every node that reaches a smaller one.

    ``a`` and ``b`` are integers. Links with a null and from a node to itself are ignored; the order
    and repetition of links don't matter; no links give no rows.
    """
    spark = links.sparkSession
    folder = run_folder(spark, "components")
    u, v = F.col(a).cast("bigint"), F.col(b).cast("bigint")
    rows = links.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
    rows.distinct().write.parquet(f"{folder}/0")
    before, number = None, 0
    while True:
        rows = spark.read.parquet(f"{folder}/{number}")
        state = rows.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return rows.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before, number = state, number + 1
        _small_star(_large_star(rows)).write.parquet(f"{folder}/{number}")


def _large_star(rows: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to its smallest neighbour, itself included."""
    both = rows.union(rows.select("v", "u"))
    smallest = both.groupBy("u").agg(F.min("v").alias("m"))
    smallest = smallest.select("u", F.least("u", "m").alias("m"))
    larger = both.where("v > u")
    return larger.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(rows: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and itself, move to the smallest of them."""
    smallest = rows.groupBy("u").agg(F.min("v").alias("m"))
    moved = rows.join(smallest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(smallest.select("u", F.col("m").alias("v"))).distinct()


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node reachable for nodes 0 … n-1, in one task's memory."""
    root = np.arange(n)
    while len(a):
        least = np.minimum(a, b)
        np.minimum.at(root, np.maximum(a, b), least)
        while True:
            further = root[root]
            if np.array_equal(further, root):
                break
            root = further
        a, b = root[a], root[b]
        open_ = a != b
        a, b = a[open_], b[open_]
    return root


def local_forest(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of links that connect all that ``a`` and ``b`` connect, and the new roots.

    ``root`` says what is connected already. In each round every tree takes one link that leaves it.
    """
    chosen = [np.zeros(0, np.int64)]
    left = np.arange(len(a))
    while True:
        ra, rb = root[a[left]], root[b[left]]
        open_ = ra != rb
        left, ra, rb = left[open_], ra[open_], rb[open_]
        if not len(left):
            return np.concatenate(chosen), root
        first = np.unique(np.concatenate([ra, rb]), return_index=True)[1] % len(left)
        first = np.unique(first)
        chosen.append(left[first])
        root = local_roots(len(root), ra[first], rb[first])[root]
