"""Alignment of two tokenizers: which tokens of one cover the same bytes as which tokens of the other.

In each batch ``merge_asof``, keyed by document, finds for every token's start the token of the other
side that covers it; both directions together are all overlaps.  Where tokens of both sides end at one
byte a group ends.  How often two ids are linked is counted over the whole corpus in a first pass.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from listing_lake.llm import words
from listing_lake.llm.tables import FILE, ROW, located, written
from listing_lake.llm.tokens import byte_letters

#: White space beyond ASCII (fixed by Unicode).
_WIDE_SPACES = [chr(c) for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
#: Bytes of text whose words are tokenized at once.
_CHUNK = 8 << 20
#: How the byte-level tokenizer cuts a text before merging (fixed, part of its format).
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BYTE = re.compile(r"<0x([0-9A-Fa-f]{2})>")


class Tokens(NamedTuple):
    """Tokens of some texts, one after another: ids, and the bytes that each covers."""

    ids: np.ndarray
    sizes: np.ndarray
    first: np.ndarray  #: index of the first token of each text, and at last their number

    def take(self, at: np.ndarray) -> Tokens:
        """The tokens of the texts ``at``, in that order."""
        count = np.diff(self.first)[at]
        first = np.concatenate([[0], np.cumsum(count)])
        place = np.arange(first[-1]) + np.repeat(self.first[at] - first[:-1], count)
        return Tokens(self.ids[place], self.sizes[place], first)


def _tokens(lists: list[list[int]], sizes: np.ndarray) -> Tokens:
    first = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    ids = np.array(list(chain.from_iterable(lists)), np.int64)
    return Tokens(ids, sizes[ids], first)


class Known(NamedTuple):
    """The words of some texts, each distinct one tokenized once."""

    word: np.ndarray  #: number of each word of the texts, one after another
    first: np.ndarray  #: index of the first word of each text, and at last their number
    a: Tokens
    b: Tokens
    same: np.ndarray  #: whether both sides give the word back byte by byte


class Pair:
    """A byte-level BPE (``a``) and a piece model that puts a space before the text (``b``).

    No token goes on from a character that is not white space to a space: the byte-level one cuts there
    before it merges, and no piece has a space behind another character.  So words are tokenized by themselves.
    """

    #: A word longer than this goes to the tokenizer's own implementation, whose regular expressions have no limit.
    long_word = 10_000

    def __init__(self, a: str, b: str):
        with open(a, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        byte_of = {letter: byte for byte, letter in byte_letters().items()}
        self.own = Tokenizer.from_file(a)
        self.own.encode_special_tokens = True
        special = {t.content for t in self.own.get_added_tokens_decoder().values()}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if t not in special}
        self.fast = tiktoken.Encoding("a", pat_str=_PARTS, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b)
        self.b_bytes = [_piece_bytes(self.pieces.id_to_piece(i)) for i in range(self.pieces.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in y], np.int64) for y in (self.a_bytes, self.b_bytes))
        self.lone = [self.pieces.piece_to_id("▁")]
        if any("▁" in self.pieces.id_to_piece(i).lstrip("▁") for i in range(self.pieces.get_piece_size())):
            raise ValueError("a piece holds a space behind another character, so texts cannot be cut into words")

    def words(self, texts: pa.Array) -> Known:
        """The words of texts with a space put before each of them; a null is an empty text."""
        space, none = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
        spaced = pc.binary_join_element_wise(space, pc.fill_null(texts.cast(pa.large_string()), none), none)
        bounds = np.frombuffer(spaced.buffers()[1], np.int64, len(spaced) + 1, spaced.offset * 8)
        data = np.frombuffer(spaced.buffers()[2], np.uint8)[: bounds[-1]]
        cut = data == 0x20
        cut[1:] &= ~_white_ends(data)[:-1]
        cut[bounds[:-1]] = True
        starts = np.flatnonzero(cut)
        offsets = pa.py_buffer(np.append(starts, bounds[-1]))
        coded = pa.LargeStringArray.from_buffers(len(starts), offsets, spaced.buffers()[2]).dictionary_encode()
        return Known(coded.indices.to_numpy(), np.searchsorted(starts, bounds), *self._tokenized(coded.dictionary))

    def _tokenized(self, distinct: pa.Array) -> tuple[Tokens, Tokens, np.ndarray]:
        plain = distinct.to_pylist()
        bounds = np.frombuffer(distinct.buffers()[1], np.int64, len(distinct) + 1, distinct.offset * 8)
        data = np.frombuffer(distinct.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
        size = np.diff(bounds)
        ends = np.cumsum(size)
        # what ends in white space is not cut off from the space behind it
        odd = np.flatnonzero((size > self.long_word) | _white_ends(data)[ends - 1])
        a = self._merged(plain, size, odd)
        # of an empty text the piece model makes nothing, of a lone space at a text's end one piece
        b = _tokens([x or self.lone for x in self.pieces.encode([w[1:] for w in plain], num_threads=1)], self.b_sizes)
        same = np.ones(len(plain), bool)
        for tokens, parts in ((a, self.a_bytes), (b, self.b_bytes)):
            at = np.concatenate([[0], np.cumsum(tokens.sizes)])
            if (at[tokens.first[1:]] == ends).all() and b"".join(map(parts.__getitem__, tokens.ids.tolist())) == data.tobytes():
                continue
            for i, word in enumerate(plain):
                own = tokens.ids[tokens.first[i] : tokens.first[i + 1]].tolist()
                same[i] &= b"".join(map(parts.__getitem__, own)) == word.encode()
        return a, b, same

    def _merged(self, plain: list[str], size: np.ndarray, odd: np.ndarray) -> Tokens:
        """Tokens of ``a``: all words but the odd ones are encoded as one text."""
        kept = np.delete(np.arange(len(plain)), odd)
        ids = np.array(self.fast.encode_ordinary("".join([plain[i] for i in kept] if len(odd) else plain)), np.int64)
        sizes = self.a_sizes[ids]
        first = np.searchsorted(np.cumsum(sizes), np.concatenate([[0], np.cumsum(size[kept])]), side="right")
        if not len(odd):
            return Tokens(ids, sizes, first)
        rest = _tokens([self.own.encode(plain[i], add_special_tokens=False).ids for i in odd], self.a_sizes)
        both = Tokens(np.concatenate([ids, rest.ids]), np.concatenate([sizes, rest.sizes]), np.concatenate([first, first[-1] + rest.first[1:]]))
        return both.take(np.argsort(np.concatenate([kept, odd])))


def _white_ends(data: np.ndarray) -> np.ndarray:
    """Whether each byte ends a white-space character, by what Unicode holds for one and the separators U+001C to U+001F."""
    one = np.zeros(256, bool)
    one[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
    out = one[data]
    if data.max(initial=0) < 0x80:
        return out
    for char in _WIDE_SPACES:
        code = char.encode()
        same = data[len(code) - 1 :] == code[-1]
        for back in range(1, len(code)):
            same &= data[len(code) - 1 - back : len(data) - back] == code[-1 - back]
        out[len(code) - 1 :] |= same
    return out


def _piece_bytes(piece: str) -> bytes:
    byte = _BYTE.fullmatch(piece)
    return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()


@lru_cache(maxsize=2)
def pair(a: str, b: str) -> Pair:
    """One per Python worker."""
    return Pair(a, b)


def _side(tokens: Tokens) -> pd.DataFrame:
    """Document, number and start of each token; documents lie one behind the other."""
    doc = np.repeat(np.arange(len(tokens.first) - 1), np.diff(tokens.first))
    start = np.cumsum(tokens.sizes) - tokens.sizes
    return pd.DataFrame({"doc": doc, "start": start, "token": np.arange(len(doc))})


def overlaps(a: Tokens, b: Tokens) -> np.ndarray:
    """Sorted (token of ``a``, token of ``b``) of all tokens whose bytes overlap; both sides hold the same texts."""
    left, right = _side(a), _side(b)
    covered = pd.merge_asof(left, right, on="start", by="doc", suffixes=("_a", "_b"))
    covering = pd.merge_asof(right, left, on="start", by="doc", suffixes=("_b", "_a"))
    # a link is found from both sides only where both tokens start at one byte
    again = left["start"].to_numpy()[covering["token_a"]] == covering["start"].to_numpy()
    covering = covering[~again]
    at, other = (np.concatenate([covered[c], covering[c]]) for c in ("token_a", "token_b"))
    order = np.lexsort((other, at))
    return np.stack([at[order], other[order]])


def _code(a_ids: np.ndarray, b_ids: np.ndarray) -> np.ndarray:
    return b_ids << 32 | a_ids


class _Sums:
    """Sums by code; what was added is summed up whenever it has grown long."""

    def __init__(self):
        self.codes, self.links = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def add(self, codes: np.ndarray, links: np.ndarray) -> None:
        self.codes.append(codes)
        self.links.append(links)
        if sum(map(len, self.codes[1:])) > len(self.codes[0]) + (1 << 20):
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        codes, links = np.concatenate(self.codes), np.concatenate(self.links)
        order = np.argsort(codes, kind="stable")
        codes, links = codes[order], links[order]
        first = np.flatnonzero(np.diff(codes, prepend=-1))
        self.codes, self.links = [codes[first]], [np.add.reduceat(links, first) if len(first) else links]
        return self.codes[0], self.links[0]


def pair_counts(docs: DataFrame, a: str, b: str) -> DataFrame:
    """``b``, ``a``, their joint ``code``, ``links``: how many links of the corpus hold two ids linked.

    No link crosses the border between two words, so links are found once per word of a batch and
    multiplied by the number of times it stands in aligned documents; tasks pass on sums.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, sums = pair(a, b), _Sums()
        for batch in words.chunks(batches, "text", _CHUNK):
            known = both.words(batch.column("text"))
            aligned = np.repeat(_alignable(known, batch.column("text")), np.diff(known.first))
            word, times = np.unique(known.word[aligned], return_counts=True)
            left, right = known.a.take(word), known.b.take(word)
            at, other = overlaps(left, right)
            sums.add(_code(left.ids[at], right.ids[other]), np.repeat(times, np.diff(left.first))[at])
        codes, links = sums.total()
        yield pa.record_batch([pa.array(codes), pa.array(links)], ["code", "links"])

    found = docs.select("text").mapInArrow(run, "code long, links long").groupBy("code").agg(F.sum("links").alias("links"))
    return found.select(F.shiftright("code", 32).alias("b"), F.col("code").bitwiseAND((1 << 32) - 1).alias("a"), "code", "links")


class Counts(NamedTuple):
    """Link counts by ascending code, and whether a count is the highest of its id of ``b``."""

    codes: np.ndarray
    links: np.ndarray
    best: np.ndarray


#: Pairs of ids whose counts every task holds at once, 17 bytes each.
HELD_PAIRS = 4_000_000
#: Words of a text that are aligned at once; no link and no group crosses a word's border.
PART_WORDS = 200_000


def _best(counts: DataFrame) -> DataFrame:
    """Counts with ``best``; an id's pairs are as many as the other side has ids."""
    highest = F.max("links").over(Window.partitionBy("b"))
    return counts.select("code", "links", (F.col("links") == highest).alias("best"))


def _held(counts: DataFrame) -> Counts:
    found = counts.toArrow()
    codes, links, best = (found.column(c).to_numpy() for c in ("code", "links", "best"))
    order = np.argsort(codes)
    return Counts(codes[order], links[order], best[order])


class _Labels:
    """Writes groups: ids of ``a`` by commas, a bar, ids of ``b`` by commas, and a semicolon."""

    def __init__(self, both: Pair):
        self.a, self.b = len(both.a_sizes), len(both.b_sizes)
        self.labels = pa.array([f"{i}{mark}" for n, marks in ((self.a, ",|"), (self.b, ",;")) for mark in marks for i in range(n)])

    def __call__(self, a: Tokens, b: Tokens, a_last: np.ndarray, b_last: np.ndarray) -> list[str]:
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        of_a, of_b = np.cumsum(np.bincount(a_group)), np.bincount(b_group)
        out = np.empty(len(a.ids) + len(b.ids), np.int64)
        out[np.arange(len(a.ids)) + (np.cumsum(of_b) - of_b)[a_group]] = a.ids + self.a * a_last
        out[np.arange(len(b.ids)) + of_a[b_group]] = 2 * self.a + b.ids + self.b * b_last
        lists = pa.LargeListArray.from_arrays(pa.array(a.first + b.first), self.labels.take(pa.array(out)).cast(pa.large_string()))
        return pc.binary_join(lists, pa.scalar("", pa.large_string())).to_pylist()


class Part(NamedTuple):
    """Some texts or parts of texts, aligned."""

    doc: np.ndarray  #: index in the batch of each of them
    a: Tokens
    b: Tokens
    at: np.ndarray  #: token of ``a`` of each link, ascending
    other: np.ndarray

    def codes(self) -> np.ndarray:
        return _code(self.a.ids[self.at], self.b.ids[self.other])

    def sums(self, of_link: np.ndarray) -> np.ndarray:
        """Sum of a number per link over each of the texts."""
        total = np.concatenate([[0], np.cumsum(of_link, dtype=np.int64)])
        return np.diff(total[np.searchsorted(self.at, self.a.first)])


def _alignable(known: Known, texts: pa.Array) -> np.ndarray:
    """Which texts have tokens: not empty, and given back whole by both sides."""
    broken = np.concatenate([[0], np.cumsum(~known.same[known.word])])
    return (np.diff(broken[known.first]) == 0) & pc.fill_null(pc.greater(pc.binary_length(texts), 0), False).to_numpy(zero_copy_only=False)


def _parts(known: Known, texts: pa.Array) -> Iterator[Part]:
    """Texts aligned in parts of about :data:`PART_WORDS` words; those that cannot be aligned are left out."""
    use = np.flatnonzero(_alignable(known, texts))
    lo, hi = known.first[use], known.first[use + 1]
    # pieces of texts, none longer than a part
    count = -(-(hi - lo) // PART_WORDS)
    doc = np.repeat(use, count)
    start = np.repeat(lo, count) + PART_WORDS * (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count))
    size = np.minimum(np.repeat(hi, count) - start, PART_WORDS)
    group = np.cumsum(size) // PART_WORDS
    for rows in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(group)) + 1):
        if len(rows):
            text = np.concatenate([[0], np.cumsum(size[rows])])
            word = known.word[np.arange(text[-1]) + np.repeat(start[rows] - text[:-1], size[rows])]
            a, b = (x._replace(first=x.first[text]) for x in (known.a.take(word), known.b.take(word)))
            yield Part(doc[rows], a, b, *overlaps(a, b))


def _aligned(docs: DataFrame, a: str, b: str, counts: Counts) -> DataFrame:
    """The result as far as ``counts`` holds the pairs."""
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(a, b)
        labels = _Labels(both)
        for batch in words.chunks(batches, "text", _CHUNK):
            sums, groups = np.zeros((len(numbers), len(batch)), np.int64), [""] * len(batch)
            for part in _parts(both.words(batch.column("text")), batch.column("text")):
                a_ends, b_ends = np.cumsum(part.a.sizes), np.cumsum(part.b.sizes)
                a_last, b_last = np.isin(a_ends, b_ends, assume_unique=True), np.isin(b_ends, a_ends, assume_unique=True)
                of, code = pd.factorize(part.codes())
                place, found = _lookup(counts, code)
                links = np.where(found, counts.links[place], 0) if len(counts.codes) else np.zeros(len(code), np.int64)
                best = found & counts.best[place] if len(counts.codes) else found
                ended = np.concatenate([[0], np.cumsum(a_last)])[part.a.first]
                own = [np.diff(part.a.first), np.diff(part.b.first), np.diff(ended), part.sums(np.ones(len(of))), part.sums(best[of]), part.sums(links[of])]
                for total, x in zip(sums, own):
                    np.add.at(total, part.doc, x)
                for i, text in zip(part.doc, labels(part.a, part.b, a_last, b_last)):
                    groups[i] += text
            rest = [batch.column(c) for c in (FILE, ROW, "doc_id")]
            texts = pa.array([g[:-1] for g in groups], pa.string())
            yield pa.record_batch([*rest, *map(pa.array, sums), texts], [FILE, ROW, "doc_id", *numbers, "groups"])

    schema = ", ".join(f"{c} long" for c in [FILE, ROW, "doc_id", *numbers])
    return docs.select(FILE, ROW, "doc_id", "text").mapInArrow(run, f"{schema}, groups string")


def _lookup(counts: Counts, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each code, and whether it is there."""
    place = np.minimum(np.searchsorted(counts.codes, code), max(len(counts.codes) - 1, 0))
    return place, (counts.codes[place] == code) if len(counts.codes) else np.zeros(len(code), bool)


def _others(docs: DataFrame, a: str, b: str, counts: Counts) -> DataFrame:
    """Place, ``code`` and ``n``: how often a document holds each pair that is not in ``counts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(a, b)
        for batch in words.chunks(batches, "text", _CHUNK):
            for part in _parts(both.words(batch.column("text")), batch.column("text")):
                codes = part.codes()
                missing = ~_lookup(counts, codes)[1]
                doc = np.repeat(part.doc, part.sums(np.ones(len(codes))))[missing]
                found = pd.DataFrame({"doc": doc, "code": codes[missing]}).value_counts(sort=False)
                doc, code = (found.index.get_level_values(i).to_numpy() for i in (0, 1))
                place = [batch.column(c).take(pa.array(doc)) for c in (FILE, ROW)]
                yield pa.record_batch([*place, pa.array(code), pa.array(found.to_numpy())], [FILE, ROW, "code", "n"])

    return docs.select(FILE, ROW, "text").mapInArrow(run, f"{FILE} long, {ROW} long, code long, n long")


def align(docs: DataFrame, a: str, b: str, held_pairs: int = HELD_PAIRS) -> DataFrame:
    """Both tokenizations of each whole text of ``docs``, aligned; one row per document.

    ``a`` is the file of a byte-level BPE, applied to a space and the text, ``b`` that of a piece model
    which adds the space itself.  ``n_a`` and ``n_b`` count tokens, ``n_groups`` the groups, ``n_links``
    pairs of tokens that overlap, ``n_best`` those whose pair of ids is as frequent in the corpus as any
    pair of the same id of ``b``; ``count_sum`` adds up these frequencies.  ``groups`` is
    ``a1,a2|b1;a3|b2,b3``.  Texts that are null or empty, or that one side does not give back byte by
    byte, have no tokens: zeros and an empty string.  Repeated rows are counted and returned one by one,
    other columns are ignored, an empty table gives an empty result.

    Tasks hold the counts of the ``held_pairs`` most frequent pairs; rarer ones, if there are more, are
    counted per document and joined.
    """
    docs = located(docs.select(F.col("doc_id").cast("long"), "text"))
    counts = written(_best(pair_counts(docs, a, b)), "pair-counts")
    if counts.count() <= held_pairs:
        return _aligned(docs, a, b, _held(counts)).drop(FILE, ROW)
    most = written(counts.orderBy(F.desc("links"), "code").limit(held_pairs), "frequent-pairs")
    held = _held(most)
    rare = counts.join(most, "code", "left_anti")
    own = _others(docs, a, b, held).join(rare, "code").groupBy(FILE, ROW).agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("rare_best"), F.sum(F.col("n") * F.col("links")).alias("rare_sum")
    )
    whole = _aligned(docs, a, b, held).join(own, [FILE, ROW], "left")
    return whole.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rare_sum", F.lit(0))).alias("count_sum"), "groups",
    )
