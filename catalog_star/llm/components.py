"""Connected components by alternating stars: rounds of joins and minima over an edge table, each written and read again."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_star.staging import stage


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Node and component (its smallest node) of every node that has an edge to another one.

    The large star ties each larger neighbour of a node to the smallest, the small star each smaller one; when neither
    changes anything, every node is tied to its component's smallest. A node of many edges is a hot key of a join
    between two shuffled tables, which adaptive execution splits; minima are combined before the shuffle.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges, before = stage(edges, "edges"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "large")
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        tied = large.join(least, "u")
        small = tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(tied.select("u", F.col("m").alias("v")))
        edges = stage(small.distinct(), "edges")
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = found


def roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Within a task: the smallest item that each of ``n`` items reaches over the given links."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        while True:
            after = label[label]
            if (after == label).all():
                break
            label = after
        differ = label[left] != label[right]
        left, right = left[differ], right[differ]
    return label
