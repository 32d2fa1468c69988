"""Word and window fingerprints of whole texts, vectorised over the bytes of an Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; one longer text is worked on alone.
CHUNK_BYTES = 1 << 20

_U64 = np.uint64
#: What tells apart the two fingerprints, and the steps of each.
_SEEDS = (0x9E3779B97F4A7C15, 0xAF251AF3B0F025B5)
_STEP, _FOLD = _U64(0xD1342543DE82EF95), _U64(0x632BE59BD9B4E019)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64: a bijection that spreads every bit over all 64."""
    x = x.astype(_U64, copy=True)
    x ^= x >> _U64(30)
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


#: Words are runs of other bytes than 0x20 and 0x09 to 0x0D; in UTF-8 these stand for themselves.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _span_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, _U64)
    np.cumsum(values, out=total[1:])
    return total[ends] - total[starts]


def _placed(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Fingerprint of ``values[start:end]`` for spans in order: the sum of what each value mixes to at its place.

    Every pair of value and place has a random number of its own, so no pattern of values cancels out.
    """
    at = np.arange(len(values), dtype=_U64)
    size = ends - starts
    if len(starts):
        inside = np.repeat(starts, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        at[inside] -= np.repeat(starts, size).astype(_U64)
    own = mix(values.astype(_U64) * _FOLD + mix(at * _STEP + _U64(seed)))
    return mix(_span_sums(own, starts, ends) + size.astype(_U64) * _STEP + _U64(seed))


def _joined(left: np.ndarray, right: np.ndarray, seed: int) -> np.ndarray:
    """Fingerprints of two neighbours as one; their order counts."""
    return mix(left * _STEP + mix(right + _U64(seed)))


class Words(NamedTuple):
    """The words of some texts, one after another."""

    hashes: np.ndarray  #: a fingerprint per word
    others: np.ndarray  #: a second one, independent of the first
    starts: np.ndarray  #: first byte of each word in ``data``
    ends: np.ndarray
    first: np.ndarray  #: index of the first word of each text, and at last the number of words
    data: np.ndarray

    def text_of(self) -> np.ndarray:
        """For each word the index of its text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def left(self) -> np.ndarray:
        """For each word the number of words from it to the end of its text."""
        return np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.hashes))

    def windows(self, length: int, second: bool = False) -> np.ndarray:
        """Fingerprint of the ``length`` words from each word on; meaningless where :meth:`left` is smaller.

        Windows of a power of two are made of two halves each, others of such windows side by side.
        """
        n, seed, power = len(self.hashes), _SEEDS[second], 1
        own = self.others if second else self.hashes
        out, have, rest = None, 0, length
        while rest:
            if rest & 1:
                part = np.zeros(n, _U64)
                part[: max(n - have, 0)] = own[have:]
                out = part if out is None else _joined(out, part, seed + power)
                have += power
            rest >>= 1
            if rest:
                later = np.zeros(n, _U64)
                later[: max(n - power, 0)] = own[power:]
                own, power = _joined(own, later, seed - power), 2 * power
        return out

    def whole(self, second: bool = False) -> np.ndarray:
        """Fingerprint of all words of each text."""
        return _placed(self.others if second else self.hashes, self.first[:-1], self.first[1:], _SEEDS[second])


def split(texts: pa.Array) -> Words:
    """Words of an Arrow array of strings; a null counts as an empty text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[bounds[0] : bounds[-1]] if body else np.empty(0, np.uint8)
    bounds = bounds - bounds[0]
    inside = ~_SPACE[data]
    starting = inside.copy()
    starting[1:] &= ~inside[:-1]
    heads = bounds[:-1][bounds[:-1] < len(data)]
    starting[heads] = inside[heads]
    ending = inside.copy()
    ending[:-1] &= ~inside[1:]
    tails = bounds[1:][bounds[1:] > 0] - 1
    ending[tails] = inside[tails]
    starts, ends = np.flatnonzero(starting), np.flatnonzero(ending) + 1
    hashes, others = (_placed(data, starts, ends, seed) for seed in _SEEDS)
    return Words(hashes, others, starts, ends, np.searchsorted(starts, bounds), data)


def chunks(batches: Iterator[pa.RecordBatch], column: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        if not len(sizes):
            continue
        group = np.cumsum(sizes) // size
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(sizes)]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) over ``width`` values from each on, shorter at the end."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        longer = out.copy()
        longer[:-step] = pick(out[:-step], out[step:])
        out, have = longer, have + step
    return out
