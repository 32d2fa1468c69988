"""Ranked lexical search: the best documents for each item of a query set, by term weights.

Documents are restricted to the items' vocabulary, and only the number of occurrences of each term
there and the length class ``m`` decide a score.  Documents that agree in both are one class: a hash
deals them, whole vectors are compared, and a class is scored once, whatever the number of its copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listing_lake.llm import words
from listing_lake.llm.tables import FILE, ROW, located, written

#: Bytes as they stand in a term: capital letters as small ones, what separates terms as a space.
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[65:91] += 32
_BYTES[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 0x20

#: Cells of a score table, and products behind it, that a task holds at once.
CELLS = 1 << 21


class Block(NamedTuple):
    """Some items: which of them hold each term of their vocabulary."""

    ids: pa.Array  #: one per item
    terms: pa.Array
    first: np.ndarray  #: index in ``items`` of the first item of each term, and at last their number
    items: np.ndarray


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of some texts one after another, and for each the index of its text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    body = texts.buffers()[2]
    data = _BYTES[np.frombuffer(body, np.uint8)[bounds[0] : bounds[-1]]] if body else np.empty(0, np.uint8)
    spaced = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(bounds - bounds[0]), pa.py_buffer(data))
    parts = pc.ascii_split_whitespace(spaced)
    flat, of = pc.list_flatten(parts), pc.list_parent_indices(parts)
    real = pc.greater(pc.binary_length(flat), 0)
    return flat.filter(real), of.filter(real).to_numpy()


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[Block]:
    """The items in blocks of about ``block_bytes`` of text; a block fits the driver and every task."""
    placed = written(located(items.select("item_id", "text")), "search-items")
    size = placed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = size // block_bytes + 1
    for block in range(count):
        part = placed.filter(F.pmod(F.xxhash64(FILE, ROW), F.lit(count)) == block).select("item_id", "text").toArrow()
        flat, of = terms(part.column("text").combine_chunks())
        if not len(flat):
            continue
        coded = flat.dictionary_encode()
        pairs = np.unique(coded.indices.to_numpy().astype(np.int64) * len(part) + of)
        term, item = np.divmod(pairs, len(part))
        yield Block(
            part.column("item_id").combine_chunks(), coded.dictionary,
            np.searchsorted(term, np.arange(len(coded.dictionary) + 1)), item,
        )


def _bags(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """``doc_id``, number of terms ``n`` and ``bag``: the vocabulary's terms in the text, then how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.chunks(batches, "text"):
            flat, of = terms(batch.column("text"))
            code = pc.index_in(flat, vocabulary)
            known = code.is_valid().to_numpy(zero_copy_only=False)
            joint = of[known] * len(vocabulary) + code.drop_null().to_numpy()
            joint, often = np.unique(joint, return_counts=True)
            doc, term = np.divmod(joint, len(vocabulary))
            size = np.bincount(doc, minlength=len(batch))
            start = np.cumsum(size) - size
            at = np.arange(len(joint)) + np.repeat(start, size)
            out = np.zeros(2 * len(joint), "<u4")
            out[at], out[at + np.repeat(size, size)] = term, often
            ends = np.concatenate([[0], np.cumsum(8 * size)]).astype(np.int64)
            bags = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(batch), [None, pa.py_buffer(ends), pa.py_buffer(out)])
            n = pa.array(np.bincount(of, minlength=len(batch)).astype(np.int64))
            yield pa.record_batch([batch.column("doc_id"), n, bags.cast(pa.binary())], ["doc_id", "n", "bag"])

    return docs.mapInArrow(run, "doc_id long, n long, bag binary")


def _entries(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, occurrences) of each entry of some bags, in the order of the rows."""
    bags = bags.cast(pa.large_binary())
    size = pc.binary_length(bags).to_numpy() // 8
    bounds = np.frombuffer(bags.buffers()[1], np.int64, len(bags) + 1, bags.offset * 8)
    flat = np.frombuffer(bags.buffers()[2], "<u4")[bounds[0] // 4 : bounds[-1] // 4]
    row = np.repeat(np.arange(len(bags)), size)
    at = np.arange(len(row)) + np.repeat(np.cumsum(size) - size, size)
    return row, flat[at].astype(np.int64), flat[at + np.repeat(size, size)].astype(np.int64)


def _holding(bags: DataFrame, vocabulary: int) -> np.ndarray:
    """Number of documents that hold each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            total += np.bincount(_entries(batch.column("bag"))[1], minlength=vocabulary)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held), pa.array(total[held])], ["term", "docs"])

    found = bags.select("bag").mapInArrow(run, "term long, docs long").groupBy("term").agg(F.sum("docs").alias("docs")).toArrow()
    out = np.zeros(vocabulary, np.int64)
    out[found.column("term").to_numpy()] = found.column("docs").to_numpy()
    return out


class _Best:
    """The best documents of each item so far, at most ``top`` of each."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.floor = np.ones(items, np.int64)  #: no lower score can enter
        self.item, self.score, self.doc, self.unnamed = (np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool))

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, unnamed: np.ndarray) -> None:
        new = ((self.item, item), (self.score, score), (self.doc, doc), (self.unnamed, unnamed))
        item, score, doc, unnamed = (np.concatenate(x) for x in new)
        order = np.lexsort((doc, unnamed, -score, item))
        place = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        order = order[place < self.top]
        self.item, self.score, self.doc, self.unnamed = item[order], score[order], doc[order], unnamed[order]
        full = place[place < self.top] == self.top - 1
        self.floor[self.item[full]] = self.score[full]


def _scored(classes: DataFrame, block: Block, weights: np.ndarray, top: int) -> DataFrame:
    """``item``, ``score``, ``doc_id``: for each item the best documents of each task."""
    count, each = len(block.ids), np.diff(block.first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(count, top)
        for batch in batches:
            row, term, often = _entries(batch.column("bag"))
            m = batch.column("m").to_numpy()
            value = 1_000_000_000 * often // (1000 * often + 8 * m[row]) * weights[term]
            # rows are taken together as far as their score table and their products stay small
            work = np.cumsum(np.bincount(row, each[term], len(batch)).astype(np.int64) + count) // CELLS
            cuts = [0, *(np.flatnonzero(np.diff(work)) + 1).tolist(), len(batch)]
            members = batch.column("members")
            for a, b in zip(cuts, cuts[1:]):
                lo, hi = np.searchsorted(row, (a, b))
                times = each[term[lo:hi]]
                entry = np.repeat(np.arange(lo, hi), times)
                place = np.arange(len(entry)) - np.repeat(np.cumsum(times) - times, times) + block.first[term[entry]]
                scores = np.zeros((b - a) * count, np.int64)
                np.add.at(scores, (row[entry] - a) * count + block.items[place], value[entry])
                scores = scores.reshape(b - a, count)
                if b - a > top:  # so many classes reach this score in these rows alone
                    best.floor = np.maximum(best.floor, np.partition(scores, b - a - top, axis=0)[b - a - top])
                of, item = np.nonzero(scores >= best.floor)
                docs = members.take(pa.array(of + a))
                doc, unnamed = docs.flatten(), pc.list_value_length(docs).to_numpy()
                best.add(
                    np.repeat(item, unnamed), np.repeat(scores[of, item], unnamed),
                    pc.fill_null(doc, 0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False),
                )
        doc = pa.array(best.doc, mask=best.unnamed)
        yield pa.record_batch([pa.array(best.item), pa.array(best.score), doc], ["item", "score", "doc_id"])

    return classes.mapInArrow(run, "item long, score long, doc_id long")


def search(docs: DataFrame, items: DataFrame, top: int = 10, block_bytes: int = 4 << 20) -> DataFrame:
    """For each item its ``top`` documents with the highest score above 0: ``item_id``, ``rank``, ``doc_id``, ``score``.

    Equal scores go by ascending ``doc_id``, null ids last.  Null and empty texts have no terms: such a
    document counts for nothing, such an item gets no rows.  Repeated rows of ``docs`` are ranked one by
    one, repeated rows of ``items`` each get their own ranks.  Other columns are ignored; without
    documents or items the result is empty.  Items are worked on in blocks of about ``block_bytes`` of
    text, each of which passes over all documents.
    """
    spark = docs.sparkSession
    schema = f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long"
    found = spark.createDataFrame([], schema)
    own = docs.select(F.col("doc_id").cast("long"), "text")
    for block in _blocks(items, block_bytes):
        bags = written(_bags(own, block.terms), "bags")
        counted, total = bags.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
        if not total:
            continue
        holding = _holding(bags, len(block.terms)).tolist()
        weights = np.array([math.floor(1000 * math.log((2 * counted + 2) / (2 * df + 1))) for df in holding], np.int64)
        ranked = _ranked(_scored(_classes(bags, counted, total, top), block, weights, top), top)
        found = found.union(_named(ranked, block.ids, schema))
    return found


def _classes(bags: DataFrame, counted: int, total: int, top: int) -> DataFrame:
    """Each class of documents with equal ``bag`` and ``m`` once, with its ``top`` smallest ids in order.

    Rows are dealt by a hash and separated by whole vectors.  A task passes on no more than ``top``
    rows of a class, so a class of any size is small in the exchange.
    """
    m = F.expr(f"10 + (cast(90 * n as decimal(20, 0)) * {counted}L) div {total}L").alias("m")
    held = bags.filter(F.length("bag") > 0).select("doc_id", "bag", m)
    held = held.select(F.xxhash64("bag", "m").alias("digest"), "m", "bag", "doc_id")
    same = ["digest", "m", "bag"]
    place = F.row_number().over(Window.partitionBy(*same).orderBy(F.col("doc_id").asc_nulls_last()))
    few = held.select("*", place.alias("place")).filter(F.col("place") <= top)
    members = F.transform(F.sort_array(F.collect_list(F.struct("place", "doc_id"))), lambda x: x["doc_id"])
    return few.groupBy(*same).agg(members.alias("members")).select("m", "bag", "members")


def _ranked(scored: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return scored.select("item", F.row_number().over(order).alias("rank"), "doc_id", "score").filter(F.col("rank") <= top)


def _named(ranked: DataFrame, ids: pa.Array, schema: str) -> DataFrame:
    """The items' own ids in place of their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = ids.take(batch.column("item"))
            yield pa.record_batch([own, *batch.columns[1:]], ["item_id", "rank", "doc_id", "score"])

    return ranked.mapInArrow(run, schema)
