"""Near-duplicate documents as bags of shingles: BagMinHash, bands, exact check.

A document is the multiset of its runs of five words.  Each shingle owns a Poisson process over its
weight, cut at powers of two: the points of the pieces below a document's weight are common to all
documents that hold the shingle as often.  The earliest point per component of the signature is the
signature; two documents agree in a component with the probability of their weighted Jaccard
similarity.  Only points early enough to matter are made.  Documents that agree in a band are compared
with the first of the band, exactly.  Bands that overlap make a family; where a family still has several
groups, all its documents are compared in tiles, so no candidate is skipped, and a pair of tiles returns
only the links that join groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listing_lake.llm import words
from listing_lake.llm.components import components
from listing_lake.llm.tables import FILE, ROW, located, packed, unpacked, written

SHINGLE, SIMILARITY = 5, 0.8
#: 32 bands of 4: two documents of similarity 0.8 share none with probability 5e-8.
BANDS, BAND_ROWS = 32, 4
COMPONENTS = BANDS * BAND_ROWS
_SEEDS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def bags(w: words.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, shingle and weight of each distinct shingle, by text.

    A text shorter than a shingle is one shingle of its own; a text without words has none.
    """
    doc, size = w.text_of(), np.diff(w.first)
    whole = w.left() >= SHINGLE
    at = np.flatnonzero(whole)
    short = np.flatnonzero((size > 0) & (size < SHINGLE))
    d = np.concatenate([doc[at], short])
    x = np.concatenate([w.windows(SHINGLE)[at], words.mix(w.whole()[short] + size[short].astype(np.uint64))])
    order = np.lexsort((x, d))
    d, x = d[order], x[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (x[1:] != x[:-1])
    first = np.flatnonzero(new)
    return d[first], x[first], np.diff(np.append(first, len(d)))


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Time of the first point in each component, for each of ``n`` bags; infinite for an empty bag."""
    out = np.full((n, COMPONENTS), np.inf)
    total = np.bincount(doc, weight, n)
    # pieces of weight: [0, 1), [1, 2), [2, 4), ... as far as a shingle's weight reaches
    levels = np.ceil(np.log2(weight)).astype(np.int64) + 1 if len(weight) else np.empty(0, np.int64)
    item = np.repeat(np.arange(len(doc)), levels)
    level = np.arange(len(item)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    length = np.maximum(low, 1)
    source = words.mix(shingle[item] + _SEEDS[0] * (level + 1).astype(np.uint64))
    owner, reach = doc[item], weight[item] - low
    # so that all components have a point in nineteen of twenty bags; the others look further
    horizon = (np.log(COMPONENTS) + 3) / np.maximum(total, 1)
    todo = total > 0
    while todo.any():
        own = todo[owner]
        _points(out, owner[own], source[own], length[own], reach[own], horizon)
        todo &= ~np.isfinite(out).all(axis=1)
        horizon = np.where(todo, horizon * 2, horizon)
    return out


def _points(out, owner, source, length, reach, horizon) -> None:
    """Lower ``out`` to the points of these processes that come before each bag's horizon."""
    now, drawn, gaps = np.zeros(len(owner)), 0, 1
    rate = length.astype(float) * COMPONENTS
    while len(owner):
        step = np.arange(drawn, drawn + gaps, dtype=np.uint64)
        seed = words.mix(source[:, None] + _SEEDS[1] * (step[None, :] + np.uint64(1)))
        gap = -np.log(((seed >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / rate[:, None]
        # sums go from the first point on, one after another, so they are equal in every bag
        time = np.add.accumulate(np.concatenate([now[:, None], gap], axis=1), axis=1)[:, 1:]
        early = time < horizon[owner][:, None]
        k, j = np.nonzero(early)
        place = (words.mix(seed[k, j] + _SEEDS[2]) >> np.uint64(11)).astype(float) * 2.0**-53 * length[k]
        inside = place < reach[k]
        k, j = k[inside], j[inside]
        component = (words.mix(seed[k, j] + _SEEDS[3]) % np.uint64(COMPONENTS)).astype(np.int64)
        np.minimum.at(out.ravel(), owner[k] * COMPONENTS + component, time[k, j])
        alive = early[:, -1]
        owner, source, length, reach, rate, now = (a[alive] for a in (owner, source, length, reach, rate, time[:, -1]))
        drawn += gaps
        gaps = min(drawn, 64)


def bands(signature: np.ndarray) -> np.ndarray:
    """A fingerprint of each band of each signature."""
    bits = signature.view(np.uint64).reshape(-1, BANDS, BAND_ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _SEEDS[0], bits.shape[:2]).copy()
    for i in range(BAND_ROWS):
        out = words.mix(out ^ bits[:, :, i])
    return out


_SIGNED = pa.schema(
    [(FILE, pa.int64()), (ROW, pa.int64()), ("doc_id", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("bands", pa.list_(pa.int64()))]
)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in words.chunks(batches, "text"):
        w, size = words.split(batch.column("text")), batch.num_rows
        doc, shingle, weight = bags(w)
        marks = bands(signatures(doc, shingle, weight, size)).view(np.int64)
        own = pa.ListArray.from_arrays(pa.array(np.arange(size + 1) * BANDS, pa.int32()), pa.array(marks.ravel()))
        both = (pa.array(w.whole(second).view(np.int64)) for second in (False, True))
        yield pa.record_batch(
            [batch.column(FILE), batch.column(ROW), batch.column("doc_id"), *both, pa.array(np.bincount(doc, weight, size).astype(np.int64)), own],
            schema=_SIGNED,
        )


def similarity(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags, each as sorted shingles and their weights."""
    at = np.searchsorted(right[0], left[0])
    same = np.flatnonzero(at < len(right[0]))
    same = same[right[0][at[same]] == left[0][same]]
    common = int(np.minimum(left[1][same], right[1][at[same]]).sum())
    total = int(left[1].sum() + right[1].sum()) - common
    return common / total if total else 0.0


def _verify(least: float):
    out = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def by_text(w: words.Words, n: int):
        doc, shingle, weight = bags(w)
        cut = np.searchsorted(doc, np.arange(n + 1))
        return [(shingle[a:b], weight[a:b]) for a, b in zip(cut, cut[1:])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                first = batch.column("text_u").dictionary_encode()
                left = by_text(words.split(first.dictionary), len(first.dictionary))
                right = by_text(words.split(batch.column("text_v")), batch.num_rows)
                good = [similarity(left[k], r) >= least - 1e-12 for k, r in zip(first.indices.to_pylist(), right)]
                yield pa.record_batch([batch.column("u"), batch.column("v")], schema=out).filter(pa.array(good, pa.bool_()))

    return run


def _star_links(stars: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs that reach the similarity, by their whole texts."""
    both = stars.join(texts.toDF("u", "text_u"), "u").join(texts.toDF("v", "text_v"), "v")
    return written(both.select("u", "v", "text_u", "text_v").mapInArrow(_verify(least), "u long, v long"), "near-links")


#: Documents of a family that are compared at once, and shingles that are multiplied at once.
_TILE, _COLUMNS = 512, 4096


def _family_links(stars: DataFrame, groups: DataFrame, texts: DataFrame, least: float, tile: int = _TILE) -> DataFrame:
    """Links that join groups of one family; each pair of tiles is a task of its own.

    ``groups`` has every node of ``stars``.  Families are found among the groups, by the stars between two of them.
    """
    labelled = groups.toDF("node", "own")
    between = stars.join(labelled.toDF("u", "own_u").hint("shuffle_hash"), "u").join(labelled.toDF("v", "own_v").hint("shuffle_hash"), "v").filter("own_u <> own_v")
    between = written(between.select(F.col("own_u").alias("u"), F.col("own_v").alias("v")).distinct(), "between")
    families = components(between).toDF("own", "family")
    labelled = written(labelled.join(families.hint("shuffle_hash"), "own"), "families")
    mixed = labelled.groupBy("family").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    tiled = labelled.join(mixed.hint("shuffle_hash"), "family").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    paired = tiled.join(texts, "node").select(
        "family", "tile", "node", "own", "text", F.explode(F.expr("sequence(0, tiles - 1)")).alias("other")
    ).withColumns({"i": F.least("tile", "other"), "j": F.greatest("tile", "other")})

    def run(rows: pa.Table) -> pa.Table:
        return _compare(rows, least)

    found = paired.select("family", "i", "j", "tile", "node", "own", "text").groupBy("family", "i", "j").applyInArrow(run, "u long, v long")
    return written(found, "family-links")


def _compare(rows: pa.Table, least: float) -> pa.Table:
    """Links between two tiles, or within one, as far as they join different groups."""
    node, own = rows.column("node").to_numpy(), rows.column("own").to_numpy()
    first = rows.column("tile").to_numpy() == rows.column("i")[0].as_py()
    inner = rows.column("i")[0] == rows.column("j")[0]
    doc, shingle, weight = bags(words.split(rows.column("text").combine_chunks()))
    # the nth copy of a shingle is an element of its own, which makes common weight a product of 0 and 1
    total = np.bincount(doc, weight, len(node))
    copy = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
    element = words.mix(np.repeat(shingle, weight) + _SEEDS[0] * copy.astype(np.uint64))
    doc = np.repeat(doc, weight)
    order = np.argsort(element, kind="stable")
    doc, new = doc[order], np.append(True, np.diff(element[order]) != 0)
    column, size = np.cumsum(new) - 1, np.diff(np.append(np.flatnonzero(new), len(doc)))
    shared = size[column] > 1
    doc, column = doc[shared], column[shared]
    column = np.cumsum(np.append(True, np.diff(column) != 0)) - 1 if len(column) else column
    left = np.flatnonzero(first)
    right = left if inner else np.flatnonzero(~first)
    common = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        a, b = np.searchsorted(column, [start, start + _COLUMNS])
        has = np.zeros((len(node), _COLUMNS), np.float32)
        has[doc[a:b], column[a:b] - start] = 1
        common += has[left] @ has[right].T
    union = total[left][:, None] + total[right][None, :] - common
    x, y = np.nonzero((common >= (least - 1e-12) * union) & (own[left][:, None] != own[right][None, :]))
    pairs = pa.table({"u": own[left][x], "v": own[right][y]})
    return pairs.group_by(["u", "v"]).aggregate([])


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id``, ``group_size``, ``kept``, and its place.

    Documents of similarity ``least`` or more are linked, linked ones share a class, named by its
    smallest id; that document stays.  Texts with the same words count as equal.  A null or empty text
    has no words: it links with nothing and stays.  A null id ranks last; of rows repeated with one id
    the first by place stays.  An empty table gives an empty result; other columns are ignored.
    """
    return _classes(located(docs.select("doc_id", "text")), least)


def _classes(placed: DataFrame, least: float) -> DataFrame:
    signed = written(
        placed.select(FILE, ROW, "doc_id", "text").mapInArrow(_sign, f"{FILE} long, {ROW} long, doc_id long, a long, b long, n long, bands array<long>"),
        "signatures",
    )
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", FILE, ROW)
    # copies become one bag, so a hot text costs one row per task
    bag = signed.filter("n > 0").groupBy("a", "b").agg(
        F.min(F.struct(order.alias("at"), "n", "bands")).alias("x"), F.count("*").alias("copies")
    )
    bag = written(
        bag.select("a", "b", "copies", F.col("x.at").alias("at"), F.col(f"x.at.{FILE}"), F.col(f"x.at.{ROW}"), F.col("x.n").alias("n"), F.col("x.bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()),
        "bags",
    )
    marks = bag.select("node", "n", F.explode("bands").alias("mark"))
    shared = marks.groupBy("mark").agg(F.min(F.struct("node", "n")).alias("first"), F.count("*").alias("members")).filter("members > 1")
    # min / max of two totals bounds the similarity, so it chooses the pairs that are compared with the first;
    # the family keeps the others too, since two members of a band may be alike when its first is of another size
    near = F.least("n", "first.n") >= F.greatest("n", "first.n") * least - 1e-9
    edges = marks.join(shared.hint("shuffle_hash"), "mark").filter(F.col("node") != F.col("first.node")).select(
        F.col("first.node").alias("u"), F.col("node").alias("v"), near.alias("near")
    ).distinct()
    edges = written(edges, "stars")
    stars = edges.filter("near").select("u", "v")
    wanted = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    texts = written(placed.join(bag.join(wanted.hint("shuffle_hash"), "node").select("node", FILE, ROW), [FILE, ROW]).select("node", "text"), "candidates")
    links = _star_links(stars, texts, least)
    groups = wanted.join(components(links).hint("shuffle_hash"), "node", "left").select("node", F.coalesce("component", "node").alias("own"))
    groups = written(groups, "groups")
    # these links are between groups, named by their smallest nodes
    merged = components(_family_links(edges.select("u", "v"), groups, texts, least)).toDF("own", "component")

    named = bag.join(groups.hint("shuffle_hash"), "node", "left").withColumn("own", F.coalesce("own", "node")).join(merged.hint("shuffle_hash"), "own", "left")
    named = written(named.select("a", "b", "copies", "at", F.coalesce("component", "own").alias("component")), "named")
    heads = named.groupBy("component").agg(F.min("at").alias("head"), F.sum("copies").alias("group_size"))
    named = named.join(heads.hint("shuffle_hash"), "component").select("a", "b", "head", "group_size")
    joined = signed.filter("n > 0").join(named.hint("shuffle_hash"), ["a", "b"]).select(
        "doc_id", F.col("head.doc_id").alias("class_id"), "group_size", order.eqNullSafe(F.col("head")).alias("kept"), FILE, ROW
    )
    alone = signed.filter("n = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), FILE, ROW
    )
    return joined.unionByName(alone)


def deduplicate(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that :func:`classes` keeps, with all their columns, whatever their names."""
    placed = packed(docs, "doc_id", "text")
    kept = _classes(placed.select("doc_id", "text", FILE, ROW), least).filter("kept").select(FILE, ROW)
    return unpacked(placed.join(kept, [FILE, ROW], "left_semi"))
