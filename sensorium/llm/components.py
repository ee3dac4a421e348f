"""Connected components by local contraction and star rounds.

Every round first contracts the edges of each task to stars (at most ``TASK_EDGES`` edges a task, in numpy),
then, unless the stars of different tasks already agree, joins them by a large-star and a small-star step on
node ids. Each result is written to the shared folder, so lineage stays short and a lost executor costs its
tasks only; two numbers reach the driver per round. Nodes with very many edges are pre-aggregated (``min``),
and their rows are split by the skew join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, written

TASK_EDGES = 1_000_000


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges to (node, least node of its component), without the least nodes themselves."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)  # hook the roots of both ends, and the ends
        np.minimum.at(root, root[b], low)
        while (root != root[root]).any():
            root = root[root]
        if (root[a] == root[b]).all():
            break
    inner = root != np.arange(len(nodes))
    return nodes[inner], nodes[root[inner]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0
    for b in batches:
        held.append((b.column(0).to_numpy(), b.column(1).to_numpy()))
        waiting += b.num_rows
        if waiting > max(len(u), 250_000):
            u, v = stars(*(np.concatenate((x, *y)) for x, y in zip((u, v), zip(*held, strict=True), strict=True)))
            held, waiting = [], 0
    if held:
        u, v = stars(*(np.concatenate((x, *y)) for x, y in zip((u, v), zip(*held, strict=True), strict=True)))
    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _large_star(edges: DataFrame) -> DataFrame:
    """The neighbours above a node move to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("low", "u").alias("low"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node (above all of its ``v``) and these move to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("low"))
    return edges.join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u <> v") \
        .unionByName(least.select("u", F.col("low").alias("v"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Every node points to one other, which points to none."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("child")).unionByName(edges.select(F.col("v").alias("n"), F.lit(0).alias("child")))
    return ends.groupBy("n").agg(F.sum("child").alias("c"), F.min("child").alias("p")).filter("c > 1 or (c = 1 and p = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) pairs of longs -> (node, root) for every node of an edge; root is the least node reachable."""
    prepare(edges)
    current = written(edges.select("u", "v"), "edges")
    while True:
        tasks = max(1, -(-current.count() // TASK_EDGES))
        current = written(current.coalesce(tasks).mapInArrow(_contract, "u long, v long"), "stars")
        if tasks == 1 or _settled(current):
            break
        current = written(_small_star(_large_star(current)), "edges")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
