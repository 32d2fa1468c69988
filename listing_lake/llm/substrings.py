"""Removal of passages that repeat, by level-wise doubling.

A window of words can only repeat where every shorter window in it repeats.  So windows of half the
length are counted first, over the whole corpus, and only where they repeat are they extended to twice
their length and counted again.  The last level counts windows of the wanted length exactly.

Of the shorter windows, one in each longer window is enough to rule that out: the one with the smallest
fingerprint, which equal windows have at equal places.  Within a batch of texts, windows met twice are
settled at once; only one row for each goes on, so a passage of the whole corpus is never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listing_lake.llm import words
from listing_lake.llm.tables import FILE, ROW, erase, located, stored, written

_PLACE = f"{FILE} long, {ROW} long"
_ANCHOR = pa.schema([(FILE, pa.int64()), (ROW, pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int32())])
_EXTENDED = pa.schema(
    [
        (FILE, pa.int64()), (ROW, pa.int64()), ("n", pa.int32()), ("doc_id", pa.int64()), ("text", pa.large_string()),
        ("n_words", pa.int64()), ("sha", pa.string()), ("at", pa.list_(pa.int32())), ("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int32())),
    ]
)
_DONE = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.large_string())]
)


def halves(length: int, shortest: int = 12) -> list[int]:
    """The lengths counted, shortest first: each is half of the next, rounded up."""
    out = [length]
    while (out[0] + 1) // 2 >= shortest:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _smallest(w: words.Words, short: int, long: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the short windows, and for each long window the smallest of those in it (0 where none fits)."""
    left, size = w.left(), len(w.hashes)
    own = w.windows(short)
    own[left < short] = np.iinfo(np.uint64).max
    least = words.sliding(own, long - short + 1, np.minimum) if size else own
    return own, np.where(left >= long, least, np.uint64(0))


def _anchors(before: int | None, short: int, long: int):
    """One level: the short windows that stand for long ones, with the number of times met here.

    ``before`` is the length of the level below, whose repeated windows stand in the column ``hits``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.chunks(batches, "text"):
            w = words.split(batch.column("text"))
            own, least = _smallest(w, short, long)
            # the smallest of some long window that it lies in
            reach = long - short + 1
            most = words.sliding(least[::-1], reach, np.maximum)[::-1] if len(own) else own
            standing = (own == most) & (most > 0)
            if before is not None:
                standing &= _alive(batch, _smallest(w, before, short)[1])
            at = np.flatnonzero(standing)
            value, first, n = np.unique(own[at], return_index=True, return_counts=True)
            doc = w.text_of()[at]
            # met once: its document waits for news of another; met again: settled for all of them
            once = n == 1
            yield _rows(batch, doc[first[once]], value[once], 1)
            twice = np.isin(own[at], value[~once])
            first, _, _ = _groups(doc[twice].astype(np.uint64), own[at][twice])
            yield _rows(batch, doc[twice][first], own[at][twice][first], 0)
            yield _rows(batch, np.zeros((~once).sum(), np.int64), value[~once], 2)
            if before is None:
                long_enough = np.flatnonzero(np.diff(w.first) >= long)
                yield _rows(batch, long_enough, w.whole()[long_enough], 3, w.whole(second=True)[long_enough])

    return run


def _groups(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of equal pairs: where one of them stands, the group of each pair, and the group's size."""
    order = np.lexsort((b, a))
    new = np.ones(len(order), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    group = np.cumsum(new) - 1
    inverse = np.empty(len(order), np.int64)
    inverse[order] = group
    return order[new], inverse, np.bincount(group, minlength=0)


def _alive(batch: pa.RecordBatch, least: np.ndarray) -> np.ndarray:
    hits = batch.column("hits").flatten().to_numpy(zero_copy_only=False)
    return np.isin(least, np.unique(hits).view(np.uint64)) & (least > 0)


def _rows(batch: pa.RecordBatch, doc: np.ndarray, value: np.ndarray, n: int, second: np.ndarray | None = None) -> pa.RecordBatch:
    """``n``: 1 met once in this document, 2 met more often somewhere, 0 already known to repeat, 3 the whole document."""
    take = pa.array(doc, pa.int64())
    b = pa.nulls(len(doc), pa.int64()) if second is None else pa.array(second.view(np.int64))
    return pa.record_batch(
        [batch.column(FILE).take(take), batch.column(ROW).take(take), pa.array(value.view(np.int64)), b, pa.array(np.full(len(doc), n, np.int32))],
        schema=_ANCHOR,
    )


def _extend(short: int, long: int):
    """Last level: the long windows whose short ones repeat; documents without any are finished here.

    Of documents with the same words, in the column ``copy``, all windows repeat.  The first of them (2)
    stands for the others (1), whose windows are not counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.chunks(batches, "text"):
            w = words.split(batch.column("text"))
            _, least = _smallest(w, short, long)
            copy = batch.column("copy").fill_null(0).to_numpy(zero_copy_only=False)
            doc, left = w.text_of(), w.left()
            at = np.flatnonzero(_alive(batch, least) & (copy[doc] == 0) | (copy[doc] == 2) & (left >= long))
            a, b = w.windows(long)[at], (w.windows(long, second=True)[at] >> np.uint64(32)).astype(np.uint32)
            where, start = doc[at], at - w.first[doc[at]]
            first, group, _ = _groups(a, b)
            # the first of some copies counts for another one, too
            total = np.bincount(group, 1 + (copy[where] == 2)).astype(np.int64)
            open_ = np.zeros(batch.num_rows, bool)
            open_[where] = True
            yield _documents(batch, w, open_ | (copy > 0))
            once = total[group] == 1
            yield _found(batch, where[once], 1, start[once], a[once], b[once])
            known, begin = where[~once], start[~once]
            rest = np.flatnonzero((copy[doc] == 1) & (left >= long))
            known, begin = np.concatenate([known, doc[rest]]), np.concatenate([begin, rest - w.first[doc[rest]]])
            order = np.lexsort((begin, known))
            yield _settled(batch, known[order], begin[order])
            again = first[total > 1]
            for part in np.array_split(again, 1 + len(again) // 100_000):
                yield _found(batch, np.zeros(len(part), np.int64), 2, np.zeros(len(part), np.int64), a[part], b[part])

    return run


def _lists(batch: pa.RecordBatch, docs: np.ndarray, n: int, cuts: np.ndarray, at: np.ndarray, *keys: np.ndarray) -> pa.RecordBatch:
    take, offsets = pa.array(docs, pa.int64()), pa.array(cuts, pa.int32())
    columns = [pa.ListArray.from_arrays(offsets, pa.array(x, t)) for x, t in zip([at, *keys], (pa.int32(), pa.int64(), pa.int32()))]
    columns += [pa.nulls(len(docs), f.type) for f in list(_EXTENDED)[7 + len(columns) :]]
    empty = [pa.nulls(len(docs), f.type) for f in list(_EXTENDED)[3:7]]
    return pa.record_batch(
        [batch.column(FILE).take(take), batch.column(ROW).take(take), pa.array(np.full(len(docs), n, np.int32)), *empty, *columns], schema=_EXTENDED
    )


def _found(batch, doc, n, start, a, b) -> pa.RecordBatch:
    """A row per document: the starts and fingerprints of its windows that are to be counted."""
    docs, cut = np.unique(doc, return_index=True)
    return _lists(batch, docs, n, np.append(cut, len(doc)), start.astype(np.int32), a.view(np.int64), b.view(np.int32))


def _settled(batch, doc, start) -> pa.RecordBatch:
    """A row per document: first and last start of each run of windows known to repeat."""
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(doc))[: len(head)] - 1
    docs, cut = np.unique(doc[head], return_index=True)
    runs = np.stack([start[head], start[tail]], axis=1).ravel().astype(np.int32)
    return _lists(batch, docs, 0, 2 * np.append(cut, len(head)), runs)


def _documents(batch: pa.RecordBatch, w: words.Words, open_: np.ndarray) -> pa.RecordBatch:
    """A row per document: its text if it may lose words, else what is kept and the digest of that."""
    kept = [None if o else _kept(w, i, None) for i, o in enumerate(open_)]
    sha = [None if k is None else hashlib.sha256(k).hexdigest() for k in kept]
    text, n = batch.column("text").cast(pa.large_string()), batch.num_rows
    text = pa.compute.if_else(pa.array(open_), text, pa.array([None if k is None else k.decode() for k in kept], pa.large_string()))
    lists = [pa.nulls(n, f.type) for f in list(_EXTENDED)[7:]]
    return pa.record_batch(
        [
            batch.column(FILE), batch.column(ROW), pa.nulls(n, pa.int32()), batch.column("doc_id"), text,
            pa.array(np.diff(w.first), pa.int64()), pa.array(sha, pa.string()), *lists,
        ],
        schema=_EXTENDED,
    )


def _kept(w: words.Words, i: int, covered: np.ndarray | None) -> bytes:
    """The words of text ``i`` that are not covered, joined by one space."""
    a, b = w.first[i], w.first[i + 1]
    starts, ends = w.starts[a:b], w.ends[a:b]
    if covered is not None:
        starts, ends = starts[~covered], ends[~covered]
    if not len(starts):
        return b""
    # each kept word with the byte after it, which becomes the space
    size = ends - starts + 1
    offset = np.cumsum(size)
    index = np.arange(offset[-1]) - np.repeat(offset - size, size) + np.repeat(starts, size)
    index[-1] = starts[-1]
    out = w.data[index]
    out[offset - 1] = 0x20
    return out[:-1].tobytes()


def _finish(length: int):
    """Last step: documents with the starts of their repeated windows lose the words these cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.chunks(batches, "text"):
            w = words.split(batch.column("text"))
            columns = {"n": [], "sha": [], "text": []}
            for i, (starts, runs) in enumerate(zip(batch.column("starts"), batch.column("runs"))):
                edge = np.zeros(w.first[i + 1] - w.first[i] + 1, np.int64)
                single = starts.values.to_numpy() if starts.is_valid else np.empty(0, np.int32)
                pairs = runs.values.to_numpy().reshape(-1, 2) if runs.is_valid else np.empty((0, 2), np.int32)
                np.add.at(edge, np.concatenate([single, pairs[:, 0]]), 1)
                np.subtract.at(edge, np.concatenate([single, pairs[:, 1]]) + length, 1)
                covered = np.cumsum(edge)[:-1] > 0
                kept = _kept(w, i, covered)
                columns["n"].append(int(covered.sum()))
                columns["sha"].append(hashlib.sha256(kept).hexdigest())
                columns["text"].append(kept.decode())
            yield pa.record_batch(
                [
                    batch.column("doc_id"), pa.array(np.diff(w.first), pa.int64()), pa.array(columns["n"], pa.int64()),
                    pa.array(columns["sha"], pa.string()), pa.array(columns["text"], pa.large_string()),
                ],
                schema=_DONE,
            )

    return run


def _repeated(table: DataFrame, key: list[str]) -> DataFrame:
    """Rows met once in their batch whose key is met elsewhere.

    Keys are counted by partial sums; the rows of a key, one for each batch, are then joined, so those of
    a key that is everywhere can be split over tasks.
    """
    total = table.groupBy(*key).agg(F.sum("n").alias("total")).filter("total > 1").select(*key)
    return table.filter("n = 1").join(total, key, "left_semi")


def _repeated_windows(windows: DataFrame) -> DataFrame:
    """:func:`_repeated` for the many windows of the last level, which are exchanged once instead of twice.

    The window over a key has one row for each batch that holds it, a few words for each MiB of text.
    """
    total = F.sum("n").over(Window.partitionBy("a", "b"))
    return windows.withColumn("total", total).filter("total > 1 AND n = 1")


def _copies(anchors: DataFrame) -> DataFrame:
    """Documents that have all their words in common with others: ``copy`` 2 for the first of them, 1 for the others."""
    place = F.struct(FILE, ROW)
    whole = anchors.filter("n = 3")
    groups = whole.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("size")).filter("size > 1")
    return whole.join(groups, ["a", "b"]).select(FILE, ROW, F.when(place == F.col("first"), 2).otherwise(1).alias("copy"))


def remove_repeats(docs: DataFrame, length: int = 35) -> DataFrame:
    """Remove each word that lies in a window of ``length`` words which also starts elsewhere, same document included.

    Returns a row per document: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and ``kept_text``:
    the remaining words joined by one space.  Windows are judged on the input.  Windows are equal when 96
    bits of two independent fingerprints of their words are.  A null or empty text has no words, rows
    repeated with the same id count as two documents, an empty table gives an empty result, other
    columns are ignored.
    """
    levels = halves(length)
    placed, place, hits, copies = located(docs.select("doc_id", "text")), [FILE, ROW], None, None
    used = []
    for before, short, long in zip([None, *levels], levels[:-1] or levels, levels[1:] or levels):
        source = placed.select(*place, "text")
        source = source if hits is None else source.join(hits, place)
        anchors, path = stored(source.mapInArrow(_anchors(before, short, long), f"{_PLACE}, a long, b long, n int"), "anchors")
        used.append((anchors, path))
        copies = copies or _copies(anchors)
        counted = anchors.filter("n IN (1, 2)").select(*place, "a", "n")
        hits = anchors.filter("n = 0").select(*place, "a").unionByName(_repeated(counted, ["a"]).select(*place, "a"))
        hits = hits.groupBy(*place).agg(F.collect_set("a").alias("hits"))
    hits = hits.select("*", F.lit(None).cast("int").alias("copy")).unionByName(copies.withColumn("hits", F.lit(None).cast("array<long>")))
    hits = hits.groupBy(*place).agg(F.flatten(F.collect_list("hits")).alias("hits"), F.max("copy").alias("copy"))
    joined = placed.join(hits, place, "left")
    extended = written(
        joined.mapInArrow(
            _extend(short, length),
            f"{_PLACE}, n int, doc_id long, text string, n_words long, sha string, at array<int>, a array<long>, b array<int>",
        ),
        "extended",
    )
    for table in used:
        erase(*table)
    windows = extended.filter("n IN (1, 2)").select(*place, "n", F.explode(F.arrays_zip("at", "a", "b")).alias("w")).select(*place, "n", "w.*")
    runs = extended.filter("n = 0").select(*place, F.lit(None).cast("int").alias("at"), F.col("at").alias("run"))
    starts = _repeated_windows(windows).select(*place, "at", F.lit(None).cast("array<int>").alias("run")).unionByName(runs)
    starts = starts.groupBy(*place).agg(F.collect_list("at").alias("starts"), F.flatten(F.collect_list("run")).alias("runs"))
    rows = extended.filter("n IS NULL")
    untouched = rows.filter("sha IS NOT NULL").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"), F.col("text").alias("kept_text")
    )
    # only documents that may lose words are moved once more
    open_ = rows.filter("sha IS NULL").select(*place, "doc_id", "text")
    done = open_.join(starts, place, "left").select("doc_id", "text", "starts", "runs").mapInArrow(
        _finish(length), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )
    return untouched.unionByName(done)
