"""Mixing sources to target weights with a hypergeometric splitting tree.

Each source is cut into blocks of documents by a hash, so a block is a random sample of its source.
Targets in words become a number of blocks per source, the last one opened to meet the target closely.
A binary tree then deals the blocks of all sources to the output shards: each node splits its exact
quotas between its halves by a multivariate hypergeometric draw, as if all blocks had been shuffled.
Every shard takes its quota from the permuted blocks of each source, without overlap, and orders its
own documents at random.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listing_lake.llm.tables import FILE, ROW, WHOLE, packed, written

#: Words as the mix counts them.
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Recipe:
    """``weights`` repeat over the sources in code point order, null last."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    share: float = 1.5  #: words to take, as a part of all words
    most: float = 2.0  #: no source and no document is taken more often
    seed: int = 20240
    block_docs: int = 256
    most_blocks: int = 16384  #: of one source; its blocks grow beyond that
    shard_blocks: int = 16
    most_sources: int = 1_000_000  #: their sizes are weighed on the driver; more is an error


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: np.ndarray, recipe: Recipe) -> np.ndarray:
    """Words to take of each source: in proportion to the weights, at most ``most`` times its size.

    What a full source leaves over goes to the others by weight, until none is over.
    """
    weights = np.resize(np.array(recipe.weights, float), len(sizes))
    limit = recipe.most * sizes
    out, full = np.zeros(len(sizes)), np.zeros(len(sizes), bool)
    left = min(recipe.share * float(sizes.sum()), float(limit.sum()))
    while not full.all():
        share = (left - limit[full].sum()) * weights / weights[~full].sum()
        over = ~full & (share > limit)
        if not over.any():
            out[~full] = share[~full]
            break
        full |= over
    out[full] = limit[full]
    return out


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Blocks of each source for each shard; rows add up to equal totals, columns to ``quotas`` exactly."""
    out = np.zeros((shards, len(quotas)), np.int64)
    nodes = [(0, shards, quotas.astype(np.int64))]
    while nodes:
        first, n, own = nodes.pop()
        if n == 1:
            out[first] = own
            continue
        half = n // 2
        taken = int(own.sum()) * half // n
        drawn = rng.multivariate_hypergeometric(own, taken, method="marginals") if taken else np.zeros_like(own)
        nodes += [(first, half, drawn), (first + half, n - half, own - drawn)]
    return out


def _sources(sized: DataFrame, recipe: Recipe) -> list[dict]:
    found = sized.groupBy("_llm_source").agg(F.sum("_llm_size").alias("size"), F.count("*").alias("docs"))
    rows = found.limit(recipe.most_sources + 1).collect()
    if len(rows) > recipe.most_sources:
        raise ValueError(f"more than {recipe.most_sources} sources")
    # UTF-8 keeps the order of code points
    rows.sort(key=lambda r: (r["_llm_source"] is None, (r["_llm_source"] or "").encode()))
    wanted = targets(np.array([r["size"] for r in rows], float), recipe)
    return [{"source": r["_llm_source"], "size": r["size"], "docs": r["docs"], "target": float(t)} for r, t in zip(rows, wanted)]


def _random(recipe: Recipe, *parts) -> Column:
    return F.xxhash64(*parts, F.lit(recipe.seed))


def copies(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """Each row of ``docs`` as ``_llm_whole``, with its place and a hash of it, ``_llm_size`` (words), ``_llm_source_size``, ``_llm_target``, ``_llm_shards``.

    ``_llm_shards`` lists the output shards that take the document, once for each copy: whole passes over
    its source, and one more where its block was drawn.  A null text has no words, a null source is a
    source of its own, sources without words have target 0.  Rows repeated with the same id and text
    share a block, unless they are more than a block holds.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    named = packed(docs, "doc_id", "text", "source").select(
        WHOLE, FILE, ROW, F.col("source").alias("_llm_source"), n_words().alias("_llm_size"), F.xxhash64("doc_id", "text").alias("_llm_key")
    )
    # one row repeated more often than a block has rows must not fill a block of its own
    often = named.groupBy("_llm_key").count().filter(F.col("count") > recipe.block_docs)
    often = written(often.select("_llm_key", F.lit(True).alias("_llm_often")), "repeated-rows")
    who = ("_llm_key", F.when(F.col("_llm_often"), F.col(ROW)))
    sized = named.join(often, "_llm_key", "left").select(
        *named.columns, (F.pmod(_random(recipe, *who), F.lit(1 << 40)) / F.lit(float(1 << 40))).alias("_llm_at"),
        _random(recipe, *who, F.lit("fill")).alias("_llm_turn"),
    )
    # narrow: blocks are drawn without the rows
    narrow = written(sized.drop(WHOLE), "sized")
    found = _sources(narrow, recipe)
    schema = "_llm_of string, _llm_src int, _llm_source_size long, _llm_target double, _llm_blocks int, _llm_passes int, _llm_rest double"
    rows = []
    for i, s in enumerate(found):
        passes = int(s["target"] // s["size"]) if s["size"] else 0
        blocks = min(recipe.most_blocks, -(-s["docs"] // recipe.block_docs))
        rows.append((s["source"], i, s["size"], s["target"], blocks, passes, s["target"] - passes * s["size"]))
    # a row per source; its size decides whether it is sent to all
    sources = written(spark.createDataFrame(rows, schema), "sources")

    def blocked(rows: DataFrame) -> DataFrame:
        own = rows.join(sources, F.col("_llm_source").eqNullSafe(F.col("_llm_of"))).drop("_llm_of", "_llm_source")
        return own.withColumn("_llm_block", F.floor(F.col("_llm_at") * F.col("_llm_blocks")).cast("int"))

    drawn = written(_drawn_blocks(blocked(narrow), recipe), "drawn-blocks")
    opened = blocked(narrow).join(drawn.filter("_llm_open IS NOT NULL"), ["_llm_src", "_llm_block"])
    short = opened.select("_llm_src", FILE, ROW, "_llm_size", "_llm_turn", "_llm_open").groupBy("_llm_src").applyInArrow(
        _left_out, f"{FILE} long, {ROW} long"
    )
    placed = blocked(sized).join(drawn.drop("_llm_open"), ["_llm_src", "_llm_block"])
    placed = placed.join(short.withColumn("_llm_less", F.lit(1)), [FILE, ROW], "left")
    shards = F.when(F.col("_llm_less").isNotNull(), F.slice("_llm_shards", 1, F.size("_llm_shards") - 1)).otherwise(F.col("_llm_shards"))
    return placed.select(WHOLE, FILE, ROW, "_llm_key", "_llm_size", "_llm_source_size", "_llm_target", shards.alias("_llm_shards"))


def _drawn_blocks(blocked: DataFrame, recipe: Recipe) -> DataFrame:
    """For each block the shards of its copies, and for the opened block of a source the words to find in it.

    A source has at most ``most_blocks`` blocks, so the windows over one source's blocks stay small.
    """
    spark = blocked.sparkSession
    words = blocked.groupBy("_llm_src", "_llm_block").agg(
        F.sum("_llm_size").alias("words"), F.first("_llm_passes").alias("passes"), F.first("_llm_rest").alias("rest")
    )
    order = Window.partitionBy("_llm_src").orderBy(_random(recipe, "_llm_src", "_llm_block"), "_llm_block")
    before = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    words = words.withColumn("before", before)
    # a block is drawn once more whole, opened, or left out
    words = written(
        words.select(
            "_llm_src", "_llm_block", "passes", F.expr("int(before < rest)").alias("extra"),
            F.expr("CASE WHEN before < rest AND before + words > rest THEN rest - before END").alias("_llm_open"),
        ),
        "blocks",
    )
    quotas = {r["_llm_src"]: r["n"] for r in words.groupBy("_llm_src").agg(F.sum(F.col("passes") + F.col("extra")).alias("n")).collect()}
    present = sorted(k for k, n in quotas.items() if n)
    counts = np.array([quotas[k] for k in present], np.int64)
    shards = max(1, -(-int(counts.sum()) // recipe.shard_blocks))
    dealt = split_quotas(counts, shards, np.random.default_rng(recipe.seed)) if len(present) else np.zeros((1, 0), np.int64)
    ends = np.cumsum(dealt, axis=0)
    ranges = [
        (int(src), int(ends[s, j] - dealt[s, j]), int(ends[s, j]), int(s))
        for j, src in enumerate(present) for s in range(shards) if dealt[s, j]
    ]
    ranges = spark.createDataFrame(ranges, "_llm_src int, lo long, hi long, shard int")
    turn = Window.partitionBy("_llm_src").orderBy(_random(recipe, "_llm_src", "_llm_block", "copy", F.lit("turn")), "_llm_block", "copy")
    instances = (
        words.filter("passes + extra > 0")
        .select("_llm_src", "_llm_block", F.explode(F.expr("sequence(1, passes + extra)")).alias("copy"))
        .withColumn("at", F.row_number().over(turn) - 1)
    )
    # each range expands to the positions it covers, which makes the lookup an equality
    seats = ranges.select("_llm_src", F.explode(F.expr("sequence(lo, hi - 1)")).alias("at"), "shard")
    taken = instances.join(seats, ["_llm_src", "at"]).groupBy("_llm_src", "_llm_block").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("copy", "shard"))), lambda x: x["shard"]).alias("_llm_shards")
    )
    none = F.array().cast("array<int>")
    return words.join(taken, ["_llm_src", "_llm_block"], "left").select(
        "_llm_src", "_llm_block", "_llm_open", F.coalesce("_llm_shards", none).alias("_llm_shards")
    )


def _left_out(rows: pa.Table) -> pa.Table:
    """Places in the opened block of one source that lose a copy: documents in random order, each if it no longer fits.

    A block has about ``block_docs`` documents, or a ``most_blocks``-th of its source.
    """
    sizes, turn = rows.column("_llm_size").to_numpy(), rows.column("_llm_turn").to_numpy()
    left, fits = rows.column("_llm_open")[0].as_py(), np.zeros(len(sizes), bool)
    for i in np.lexsort((sizes, turn)):
        if sizes[i] <= left:
            fits[i] = True
            left -= int(sizes[i])
    return rows.select([FILE, ROW]).filter(pa.array(~fits))


def drawn(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """The mix with the place that each row was read from: whole rows by output shard, shuffled inside each."""
    out = copies(docs, recipe).select(WHOLE, FILE, ROW, "_llm_key", F.posexplode("_llm_shards").alias("_llm_copy", "_llm_shard"))
    return out.repartition("_llm_shard").sortWithinPartitions("_llm_shard", _random(recipe, "_llm_key", "_llm_copy", F.lit("shuffle")))


def mix(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """The mix: a row of ``docs`` for each copy, in files by output shard and shuffled inside each.

    See :func:`copies` for nulls, ties and repeated rows; a document of no words is taken with its block.
    Columns keep their names, whatever these are.
    """
    return drawn(docs, recipe).select(f"{WHOLE}.*")
