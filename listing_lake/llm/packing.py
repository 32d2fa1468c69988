"""Packing documents into fixed windows of tokens.

Only the histogram of lengths is planned, which has as many entries as a window has tokens, whatever
the documents.  Short combinations of two or three lengths that fill a window exactly are enumerated;
how often to use each is a non-negative least-squares fit to the histogram, rounded.  What is left is
packed greedily, and cut where a gap would be large.  The plan says which ranks of each length go where;
each piece finds its place by its length and rank.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listing_lake.llm import words
from listing_lake.llm.tables import written
from listing_lake.llm.tokens import word_tokens

WINDOW = 2048
#: The id behind each document.
END_ID = 1
_PIECE = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("doc_tokens", pa.int64()), ("ids", pa.binary()),
        ("task", pa.int32()), ("turn", pa.int64()),
    ]
)
_PLACED = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary()),
        ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ]
)


def _tokenise(tokenizer: str, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, task = word_tokens(tokenizer), TaskContext.get().partitionId()
        turns = np.zeros(window + 1, np.int64)
        for batch in words.chunks(batches, "text", 2 * words.CHUNK_BYTES):
            ids, bounds = ids_of(batch.column("text"))
            # the end id behind each document
            ids = np.insert(ids, bounds[1:], np.uint32(END_ID))
            size = np.diff(bounds) + 1
            count = -(-size // window)
            doc = np.repeat(np.arange(len(size)), count)
            start = window * (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count))
            length = np.minimum(window, size[doc] - start)
            # pieces cover all ids in order
            edge = pa.py_buffer(np.concatenate([[0], np.cumsum(4 * length)]).astype(np.int32))
            own = pa.BinaryArray.from_buffers(pa.binary(), len(doc), [None, edge, pa.py_buffer(ids.astype("<u4"))])
            order = np.argsort(length, kind="stable")
            turn = np.empty(len(doc), np.int64)
            turn[order] = turns[length[order]] + np.arange(len(doc)) - np.searchsorted(length[order], length[order])
            turns += np.bincount(length, minlength=window + 1)
            columns = [batch.column("doc_id").take(pa.array(doc)), start, length, size[doc], own, np.full(len(doc), task), turn]
            yield pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _PIECE)], schema=_PIECE)

    return run


def combinations(counts: np.ndarray, window: int, per_length: int = 6) -> np.ndarray:
    """Pairs and triples of present lengths that add up to ``window``, as rows of three, 0 for none.

    All pairs, and for each length the ``per_length`` triples whose rarest part is the most frequent.
    """
    present = np.flatnonzero(counts[:window])
    present = present[present > 0]
    pairs = [(a, window - a, 0) for a in present if a <= window - a and counts[window - a]]
    triples: set[tuple[int, int, int]] = set()
    for a in present:
        b = present[present <= window - a - 1]
        c = window - a - b
        b, c = b[counts[c] > 0], c[counts[c] > 0]
        least = np.minimum(counts[b], counts[c])
        for k in np.lexsort((b, -least))[: 2 * per_length]:
            triples.add(tuple(sorted((int(a), int(b[k]), int(c[k])), reverse=True)))
    return np.array(pairs + sorted(triples), np.int64).reshape(-1, 3)


def solve(combos: np.ndarray, counts: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Repeats ``x >= 0`` of the combinations with ``A x`` nearest to ``counts``, by multiplicative updates.

    ``A`` has a 1 for each part of a combination.  An update keeps signs and never increases the error.
    """
    parts = combos.T
    target = counts.astype(float)
    target[0] = 0
    x = np.full(len(combos), max(target.sum() / max(1, len(combos) * 3), 1e-9))
    wanted = target[parts].sum(axis=0)
    for _ in range(rounds):
        fitted = sum(np.bincount(p, x, len(counts)) for p in parts)
        fitted[0] = 0
        x *= wanted / np.maximum(fitted[parts].sum(axis=0), 1e-12)
    return x


class _Plan:
    """Hands out the pieces of each length by rank and notes where they go."""

    def __init__(self, counts: np.ndarray, window: int):
        self.window, self.left, self.sequences = window, counts.copy(), 0
        #: By length: runs of (length of the whole piece, first rank, pieces, where in it the part starts).
        self.runs = [deque([(n, 0, int(c), 0)] if c else []) for n, c in enumerate(counts)]
        self.notes: list[tuple[int, int, int, int, int, int, int]] = []

    def fill(self, parts: list[int], times: int, cut: tuple[int, int] | None = None) -> None:
        """``times`` sequences of pieces of these lengths; ``cut`` adds the first part of a longer piece."""
        offset = 0
        for n in parts:
            self._take(n, n, times, offset)
            offset += n
        if cut:
            self._take(cut[0], cut[1], times, offset)
        self.sequences += times

    def _take(self, length: int, used: int, times: int, offset: int) -> None:
        self.left[length] -= times
        at = 0
        while at < times:
            whole, rank, n, start = self.runs[length].popleft()
            take = min(n, times - at)
            self.notes.append((whole, start, rank, take, used, self.sequences + at, offset))
            if take < n:
                self.runs[length].appendleft((whole, rank + take, n - take, start))
            if used < length:
                self.runs[length - used].append((whole, rank, take, start + used))
                self.left[length - used] += take
            at += take


def plan(counts: np.ndarray, window: int = WINDOW, gap: int = 16) -> np.ndarray:
    """Where the pieces go: rows of (length of the whole piece, start of the part, first rank, pieces, length of the part, first sequence, offset).

    ``counts[n]`` pieces have length ``n``.  Ranks follow each other from the first, sequences too.  A gap
    of more than ``gap`` tokens is filled by cutting a piece while there are any.
    """
    p = _Plan(counts, window)
    if p.left[window]:
        p.fill([window], int(p.left[window]))
    combos = combinations(p.left, window)
    if len(combos):
        x = solve(combos, p.left)
        for k in np.argsort(-x, kind="stable"):
            parts = [int(n) for n in combos[k] if n]
            most = min(int(p.left[n]) // parts.count(n) for n in parts)
            times = min(most, int(np.rint(x[k])))
            if times > 0:
                p.fill(parts, times)
    while p.left.any():
        parts, rest, free = [], window, p.left.copy()
        while rest:
            fits = np.flatnonzero(free[: rest + 1])
            if not len(fits):
                break
            n = int(fits[-1])
            parts.append(n)
            free[n] -= 1
            rest -= n
        longer = np.flatnonzero(free)
        cut = (int(longer[-1]), rest) if rest > gap and len(longer) else None
        times = min(int(p.left[n]) // (parts.count(n) + (cut is not None and cut[0] == n)) for n in {*parts, *([cut[0]] if cut else [])})
        p.fill(parts, max(times, 1), cut)
    return np.array(p.notes, np.int64).reshape(-1, 7)


def _place(notes: np.ndarray):
    """Each piece to its sequence, in the parts the plan cuts it into."""
    order = np.lexsort((notes[:, 2], notes[:, 1], notes[:, 0])) if len(notes) else []
    notes = notes[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the plan's rows by whole length and start of the part, then by rank
        heads = {}
        for at, (whole, start) in enumerate(map(tuple, notes[:, :2])):
            low, _ = heads.get((whole, start), (at, at))
            heads[whole, start] = (low, at + 1)
        firsts = notes[:, 2]
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "start", "length", "doc_tokens", "ids", "rank")]
            out: list[tuple] = []
            for doc, begin, length, n, ids, rank in zip(*columns):
                at = 0
                while at < length:
                    low, high = heads[length, at]
                    k = low + int(np.searchsorted(firsts[low:high], rank, "right")) - 1
                    _, _, first, _, used, sequence, offset = map(int, notes[k])
                    out.append((doc, begin + at, used, n, ids[4 * at : 4 * (at + used)], sequence + rank - first, offset))
                    at += used
            if out:
                yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*out), _PLACED)], schema=_PLACED)

    return run


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``doc_tokens``, ``ids``, ``sequence_id``, ``offset``.

    A document is its ids (little-endian, 32 bits each) and the id 1; a null text is empty.  Documents
    longer than a window are cut every ``window`` tokens; each id is in one piece.  Sequences are
    numbered from 0 and hold their pieces without gaps from offset 0; room at the end is padding.  Rows
    repeated with the same id, and null ids, are documents of their own; an empty table gives an empty
    result; other columns are ignored.
    """
    pieces = written(
        docs.select("doc_id", "text").mapInArrow(
            _tokenise(tokenizer, window), "doc_id long, start long, length int, doc_tokens long, ids binary, task int, turn long"
        ),
        "pieces",
    )
    runs = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    runs = written(runs.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "runs")
    counts = np.zeros(window + 1, np.int64)
    for r in runs.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most a row per length
        counts[r["length"]] = r["n"]
    ranked = pieces.join(runs.select("length", "task", "before"), ["length", "task"]).select(
        "doc_id", "start", "length", "doc_tokens", "ids", (F.col("before") + F.col("turn")).alias("rank")
    )
    return ranked.mapInArrow(
        _place(plan(counts, window)), "doc_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long"
    )
