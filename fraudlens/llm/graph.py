"""Connected components of links, and small helpers for groups of rows inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm.storage import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of a link; the component is its smallest node.

    Alternates two steps until nothing changes: larger neighbours move to a node's smallest
    neighbour, then all smaller ones do. Each step is two shuffles with sums on the map side, and
    ends in a written table. The rounds grow with the logarithm of the longest path.
    """
    spark = links.sparkSession
    low, high = F.least(a, b), F.greatest(a, b)
    edges = written(links.where(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct(), "links")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        wide = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = wide.groupBy("u").agg(F.min("v").alias("m"))
        near = wide.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(near.union(least).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.count_distinct("u")).first()
        if now == before or now[0] == 0:
            break
        before = now
    hubs = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(hubs).distinct()


def roots(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric boolean matrix, the first row that it is connected with."""
    n = len(linked)
    label = np.arange(n)
    while True:
        least = np.where(linked, label[None, :], n).min(1, initial=n)
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def runs(*keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of each run of equal keys."""
    n = len(keys[0])
    if not n:
        return
    change = np.zeros(n, bool)
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    heads = np.flatnonzero(change)
    yield from zip(np.concatenate([[0], heads]).tolist(), np.concatenate([heads, [n]]).tolist(), strict=True)
