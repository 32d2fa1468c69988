"""Near-duplicate vectors by quantised tiles.

Vectors of one label are cut into tiles.  Each pair of tiles is multiplied in 8-bit integers, and every
vector's own quantisation error bounds how far a product may be off.  Only pairs that may reach the
threshold within that bound are computed again in double precision.  A pair of tiles returns a row per
linked vector: how many links it has there, and the smallest vector it is connected to.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listing_lake.llm.components import components, unite
from listing_lake.llm.tables import written

#: Rows of a tile that are multiplied at once, and pairs that are computed again at once.
_BLOCK, _PAIRS = 512, 1 << 16
#: Room for rounding in the bound itself.
_SLACK = 1e-6


def links(vectors: DataFrame, threshold: float = 0.98, tile: int = 4096) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    Vectors are linked when their labels are equal and their cosine in double precision reaches
    ``threshold`` (above 0).  A vector links with nothing, and stays, when it or its label is null, when
    it is zero, or when it holds a null or a non-finite number; vectors of different lengths do not
    link.  Equal vectors of a label are compared once and counted as often as they occur, so copies cost
    nothing.  Rows repeated with one id count as two vectors; a null id is never a component's id unless
    all are null.  An empty table gives an empty result; other columns are ignored.
    """
    rows = vectors.select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    sound = F.coalesce(F.col("label").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("sound", sound)
    distinct = rows.filter("sound").groupBy("label", "v").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    distinct = written(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")

    found = written(_tile_links(distinct, threshold, tile), "links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.filter("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")))
    named = distinct.select("node", "least").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    described = (
        distinct.join(named.select("node", "component"), "node").join(least, "component").join(counts, "node", "left")
        .select("label", "v", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    )
    linked = rows.filter("sound").join(described, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _tile_links(distinct: DataFrame, threshold: float, tile: int) -> DataFrame:
    """``node``, its ``links`` and the smallest node it is connected to, for each pair of tiles."""
    sized = distinct.withColumn("dim", F.size("v"))
    tiles = sized.groupBy("label", "dim").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    own = sized.join(tiles, ["label", "dim"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    paired = own.select(
        "label", "dim", "own", "node", "copies", "v", F.explode(F.expr("sequence(0, tiles - 1)")).alias("other")
    ).withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})

    def run(rows: pa.Table) -> pa.Table:
        return _pair(rows, threshold)

    return paired.select("label", "dim", "i", "j", "own", "node", "copies", "v").groupBy("label", "dim", "i", "j").applyInArrow(
        run, "node long, links long, root long"
    )


def _quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """8-bit parts, step and length of the error of each unit vector."""
    step = np.abs(unit).max(axis=1) / 127
    parts = np.rint(unit / step[:, None]).astype(np.int8)
    return parts, step, np.linalg.norm(unit - parts * step[:, None], axis=1)


def _pair(rows: pa.Table, threshold: float) -> pa.Table:
    node, copies = rows.column("node").to_numpy(), rows.column("copies").to_numpy()
    i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
    own = rows.column("own").to_numpy()
    order = np.lexsort((node, own != i))
    node, copies, own = node[order], copies[order], own[order]
    v = rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(node), -1)[order]
    unit = v / np.abs(v).max(axis=1)[:, None]
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    parts, step, error = _quantised(unit)
    # sums of products of 8-bit numbers are whole, and exact in this type
    exact = np.float32 if unit.shape[1] <= 1024 else np.float64
    left = np.flatnonzero(own == i)
    right = left if i == j else np.flatnonzero(own != i)
    second = parts[right].astype(exact).T
    links, root = np.zeros(len(node), np.int64), np.arange(len(node))
    for a in range(0, len(left), _BLOCK):
        block = left[a : a + _BLOCK]
        product = (parts[block].astype(exact) @ second) * (step[block][:, None] * step[right][None, :])
        bound = (1 + error[block][:, None]) * error[right][None, :] + error[block][:, None] + _SLACK
        r, c = np.nonzero(product + bound >= threshold)
        r, c = block[r], right[c]
        if i == j:
            r, c = r[r < c], c[r < c]
        for b in range(0, len(r), _PAIRS):
            x, y = r[b : b + _PAIRS], c[b : b + _PAIRS]
            close = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
            x, y = x[close], y[close]
            links += np.bincount(x, copies[y], len(node)).astype(np.int64) + np.bincount(y, copies[x], len(node)).astype(np.int64)
            unite(root, x, y)
    least = np.full(len(node), np.iinfo(np.int64).max)
    np.minimum.at(least, root, node)
    some = links > 0
    return pa.table({"node": node[some], "links": links[some], "root": least[root][some]})
