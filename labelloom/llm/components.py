"""Connected components of links that no machine holds as a whole."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.work import stored, tidy

#: Edges that a task contracts at a time.
BLOCK_EDGES = 1 << 20


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node that the edges tie to a smaller one, and the smallest that they tie it to."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low < high
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (root != root[root]).any():
            root = root[root]
    tied = root != np.arange(len(nodes))
    return nodes[tied], nodes[root[tied]]


def _contracted(block: int):
    """The edges ``(u, v)`` of a task, block by block as forests: fewer edges, the same components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def tied() -> pa.RecordBatch:
            u, v = (np.concatenate(side) for side in zip(*held, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in forest(u, v)], ["u", "v"])

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size >= block:
                yield tied()
                held, size = [], 0
        if size:
            yield tied()

    return tidy(run)


def _with_least(edges: DataFrame, key: str) -> DataFrame:
    """``edges`` with ``least``: the smallest number among ``key`` and its neighbours. The sums per
    key are made before the shuffle and stored, so the join's own shuffles can be split by size."""
    other = "v" if key == "u" else "u"
    least = stored(
        edges.groupBy(key).agg(F.least(F.min(other), F.col(key)).alias("least")), "least"
    )
    return edges.join(least, key)


def _settled(edges: DataFrame) -> bool:
    """Whether each node hangs from one other at most, and nothing from a node that hangs."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).union(
        edges.select("v", F.lit(0))
    )
    times = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("low"))
    return times.where("ups > 1 OR (ups = 1 AND low = 0)").isEmpty()


def components(links: DataFrame, block_edges: int = BLOCK_EDGES) -> DataFrame:
    """``(node, component)`` for the links ``(a, b)``: the component is its smallest node.

    Each task first contracts the edges it has to forests, which settles all if they are few. Else two
    steps alternate: each node hands its smallest neighbour to its larger neighbours, then to itself
    and its smaller ones. The paths halve, so the rounds grow as the logarithm of the longest one.
    Nodes without links have no row. No links: no rows.
    """

    def contracted(edges: DataFrame) -> DataFrame:
        return edges.mapInArrow(_contracted(block_edges), "u long, v long")

    edges = links.select(
        F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v")
    )
    edges = stored(contracted(contracted(edges.where("u <> v")).distinct()), "edges")
    while not _settled(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            _with_least(stored(both, "both"), "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("least").alias("v"))
            .where("u <> v")
            .distinct()
        )
        small = _with_least(stored(large, "large"), "u")
        edges = (
            small.select(F.col("v").alias("u"), F.col("least").alias("v"))
            .union(small.select("u", F.col("least").alias("v")))
            .where("u <> v")
            .distinct()
        )
        edges = stored(contracted(edges), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", F.col("v").alias("w")).distinct()
    )
