"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listing_lake.llm.tables import written

#: Edges that a task puts together at once.
_AT_ONCE = 1 << 19
#: Shuffle partitions of edges, two numbers each, that one task takes.
_PARTS = 16


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it reaches, for every node (a long) of ``edges`` (``u``, ``v``).

    Rounds of "large star, small star": every node's larger neighbours move to its smallest neighbour,
    then its smaller ones do, until every node has one smaller neighbour that has none itself.  Before the
    first round and after each one every task puts its own edges together, so a graph that fits one task needs no
    round, and the rounds of others have fewer edges.  Each round is a written table, so a lost executor costs
    one round at most; the number of rounds grows with the logarithm of the longest path.  Joins
    shuffle both sides, so the driver fetches none; the side that is hashed has each key once.  Self-links are allowed,
    null ends are not.  An empty table gives an empty result.
    """
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    once = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = written(_put_together(once), "edges")
    while not _stars_only(now):
        now = written(_put_together(_small_star(_large_star(now))), "edges")
    return nodes.join(now.select(F.col("u").alias("node"), F.col("v").alias("to")).hint("shuffle_hash"), "node", "left").select(
        "node", F.coalesce("to", "node").alias("component")
    )


def unite(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Join the sets of ``x`` and ``y``; ``root`` names the first row of each row's set."""
    while True:
        a, b = root[x], root[y]
        apart = a != b
        if not apart.any():
            return
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (root[root] != root).any():
            root[:] = root[root]


def _put_together(edges: DataFrame) -> DataFrame:
    """The same components with, in each task, one edge from each node to the smallest one that its edges reach."""
    tasks = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")) // _PARTS
    return edges.coalesce(max(1, tasks)).mapInArrow(_stars, "u long, v long")


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        kept.append(batch)
        if sum(b.num_rows for b in kept) >= _AT_ONCE:
            yield _star(pa.Table.from_batches(kept))
            kept = []
    if kept:
        yield _star(pa.Table.from_batches(kept))


def _star(edges: pa.Table) -> pa.RecordBatch:
    nodes, at = np.unique(np.concatenate([edges.column("u").to_numpy(), edges.column("v").to_numpy()]), return_inverse=True)
    root = np.arange(len(nodes))
    unite(root, at[: edges.num_rows], at[edges.num_rows :])
    moved = root != np.arange(len(nodes))
    return pa.record_batch([pa.array(nodes[moved], pa.int64()), pa.array(nodes[root[moved]], pa.int64())], ["u", "v"])


def _stars_only(edges: DataFrame) -> bool:
    """Whether each ``u`` comes once and is no ``v``, which is what the rounds end in."""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or up > 0 and down > 0").isEmpty()


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("v", "u"))
    low = _least(both).select("u", F.least("u", "low").alias("low"))
    return both.join(low.hint("shuffle_hash"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    joined = edges.join(_least(edges).hint("shuffle_hash"), "u")
    pairs = F.array(F.struct(F.col("v").alias("u"), F.col("low").alias("v")), F.struct("u", F.col("low").alias("v")))
    return joined.select(F.inline(pairs)).filter("u <> v").distinct()
