"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicwake.llm.jobs import Batches, map_arrow
from topicwake.session import materialize


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union-find over the edges: each node that is not the least of its component, and that least node."""
    nodes, codes = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = codes[: len(u)], codes[len(u) :]
    parent = np.arange(len(nodes))
    while True:  # all edges at once: hang the greater root below the lesser, then shorten the paths
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
    inner = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[inner], nodes[parent[inner]]


def _local(batches: Batches) -> Batches:
    """Every few hundred thousand edges of a partition become a forest of stars."""
    held, n = [], 0

    def flush():
        u, v = forest(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))
        return pa.record_batch([pa.array(u), pa.array(v)], names=["u", "v"])

    for batch in batches:
        held.append((np.asarray(batch.column(0)), np.asarray(batch.column(1))))
        n += batch.num_rows
        if n >= 1 << 19:
            yield flush()
            held, n = [], 0
    if held:
        yield flush()


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v: long) that is not the least of its component.

    ``component`` is the least node reachable. Union-find first shrinks the edges of each partition to
    stars; then large-star and small-star rounds alternate until nothing changes, a number of rounds that
    grows with the logarithm of the size. Minima are aggregated before they are exchanged, written, and
    joined back, so that Spark can split a node with a third of all edges like any skewed key. Every round is a written table.
    """
    edges = edges.where("u <> v").select("u", "v")
    edges = materialize(map_arrow(edges, _local, "u long, v long").distinct(), "edges")
    mark = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        edges = materialize(small.distinct(), "stars")
        now = _mark(edges)
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = now
