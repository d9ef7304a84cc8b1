"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from skyledger.sources.shared import written

#: Edges a task should have: small tables stay in few tasks and files, whatever the number of shuffle partitions.
TASK_EDGES, LEAST_TASKS = 1 << 15, 6
#: Edges that a task joins at a time.
AT_ONCE = 1 << 17


def lowest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component labels of n points under links a-b: the lowest index."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(before, label):
            break
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def _stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges (a, b) as edges from each node to the smallest that those of this task reach, a bounded number at a time."""
    def joined(held: list[pd.DataFrame]) -> pd.DataFrame:
        a, b = (np.concatenate([x[side].to_numpy(np.int64) for x in held]) for side in "ab")
        node, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        label = lowest(len(node), at[: len(a)], at[len(a) :])
        moved = np.flatnonzero(label != np.arange(len(node)))
        return pd.DataFrame({"a": node[moved], "b": node[label[moved]]})

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= AT_ONCE:
            yield joined(held)
            held, n = [], 0
    if held:
        yield joined(held)


def _counted(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """``edges``, joined within each task, as a table in the shared folder, with its number of rows and the sum of their hashes, taken while it is written."""
    seen = Observation()
    out = written(edges.mapInPandas(_stars, "a long, b long").observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hashes")), "cc")
    return out, (seen.get["n"], seen.get["hashes"])


def components(edges: DataFrame) -> DataFrame:
    """(a, b), longs, to (node, component): component is the smallest node reachable.

    Only nodes with an edge are returned. Each step is a grouped minimum and a join on it, so a node
    with very many neighbours is never gathered; each step's table goes to the shared folder. Before the first step and after each, tasks join what
    their own edges reach, which makes paths short and leaves few repeated edges. No part of a step makes more edges or moves an end to a larger node,
    so the edges are the same before and after a step only where each node is linked to its smallest. The
    number of steps grows with the logarithm of the longest path.
    """
    edges, now = _counted(edges.where("a <> b").select("a", "b"))
    before = None
    while now != before:
        before = now
        tasks = max(LEAST_TASKS, -(-2 * now[0] // TASK_EDGES))  # each edge is met from both ends
        # Large star: every larger neighbour of a node is linked to the node's smallest neighbour or itself.
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.coalesce(tasks), "cc")  # a row an edge at most
        # Small star: a node and its smaller neighbours are linked to the smallest of these.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = small.unionByName(least.select("a", F.col("m").alias("b")))
        edges, now = _counted(edges.coalesce(tasks))
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")))
    return ends.distinct().coalesce(tasks)
