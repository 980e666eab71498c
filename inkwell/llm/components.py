"""Connected components of graphs of any size."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, ship
from .text_arrays import lean

#: Edges (16 bytes each) that one task may take; a graph with more goes through distributed rounds.
SMALL = 1 << 19


def components(edges: DataFrame, small: int = SMALL) -> DataFrame:
    """(node, root) of every node that has an edge; root is the least node of its component.

    ``edges`` has two columns of 64-bit numbers; loops, repeats and either direction are allowed, rows
    with a null are left out, and an empty table gives an empty result.  A graph of at most ``small``
    different edges, counted first, is labelled by one task, which saves the rounds' many short stages; its
    result is the same.  In a larger one large-star and
    small-star steps alternate: each hangs nodes on the least node known near them.  A step
    is an aggregation by node (a minimum, so a hot node costs one row per task) and a join whose
    skewed side AQE splits; no neighbourhood is ever gathered.  Every round ends in a
    checkpoint, the number of rounds grows with the logarithm of the longest path.
    """
    a, b = edges.columns
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where((F.col(a) != F.col(b)) & F.col(a).isNotNull() & F.col(b).isNotNull())
    e = cut(e.distinct())
    if e.limit(small + 1).count() <= small:
        ship(e.sparkSession)
        return e.coalesce(1).mapInArrow(lean(_labelled), "node long, root long")
    while not _stars(e):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).withColumnRenamed("u", "x")
        large = both.where(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least.withColumnRenamed("u", "x"), F.col("u") == F.col("x")).where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(moved.union(least.select("u", F.col("m").alias("v"))).distinct())
    roots = e.select("v").distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))


def _labelled(batches):
    """The components of all edges of the batches: every root is hung on the least root that an edge shows, and
    paths are halved until all nodes point at their root."""
    parts = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
    if not parts:
        return
    u, v = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    x, y = place[: len(u)], place[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while not (root[root] == root).all():
            root = root[root]
    for k in range(0, len(nodes), 100_000):
        part = slice(k, k + 100_000)
        yield pa.RecordBatch.from_arrays([pa.array(nodes[part]), pa.array(nodes[root[part]])], ["node", "root"])


def _stars(e: DataFrame) -> bool:
    """Whether every edge (u, v) hangs a node with no other edge on a root."""
    if e.join(e.select(F.col("u").alias("w")).distinct(), F.col("v") == F.col("w"), "left_semi").limit(1).count():
        return False
    return not e.groupBy("u").count().where("count > 1").limit(1).count()
