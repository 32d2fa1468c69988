"""Token ids of whole texts by a public tokenizer, remembered word by word."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself where it prints, else the next one from U+0100 on."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printing]
    return {b: chr(b) for b in printing} | {b: chr(256 + i) for i, b in enumerate(others)}


#: Runs of other bytes than these are words.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ASCII = np.zeros(256, bool)
_ASCII[[*range(65, 91), *range(97, 123)]] = True
#: Visible ASCII that is no letter.
_SIGN = ~_SPACE & ~_ASCII & (np.arange(256) < 128)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _letters(data: np.ndarray) -> np.ndarray:
    """Bytes of A-Z, a-z and the letters of two bytes from U+00C0 to U+024F that are one letter in lower case too."""
    letter = _ASCII[data]
    lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC9))
    lead = lead[lead + 1 < len(data)]
    code = (data[lead].astype(np.int32) & 0x1F) << 6 | data[lead + 1] & 0x3F
    lead = lead[(code <= 0x24F) & ~np.isin(code, (0xD7, 0xF7, 0x130))]
    letter[lead] = letter[lead + 1] = True
    return letter


def pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in parts that the tokenizer takes one by one, and the first part of each text and at last their number.

    It never joins a letter with a sign behind it, nor a sign with a letter behind it unless the sign is an
    apostrophe, so words are cut there, and A-Z without combining marks are lower-cased as it does.  Words with a
    ``<`` are left as they are, since its special tokens begin with it.  A null has no words.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[bounds[0] : bounds[-1]] if body else np.empty(0, np.uint8)
    bounds = bounds - bounds[0]
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = bounds[:-1][bounds[:-1] < len(data)]
    begins[heads] = inside[heads]
    letter, sign, low = _letters(data), _SIGN[data], _LOWER[data]
    # a mark may join with the small letter only
    mark = np.flatnonzero((data[1:] >= 0x80) & ~letter[1:])
    low[mark] = data[mark]
    cut = np.zeros(len(data), bool)
    cut[1:] = letter[:-1] & sign[1:] | sign[:-1] & (data[:-1] != ord("'")) & letter[1:]
    angle = np.flatnonzero(data == ord("<"))
    if len(angle):
        word = np.cumsum(begins, dtype=np.int32)
        own = np.zeros(word[-1] + 1, bool)
        own[word[angle]] = True
        left = own[word]
        cut &= ~left
        low = np.where(left, data, low)
    begins |= cut
    edges = np.append(np.flatnonzero(begins[inside]), np.count_nonzero(inside)).astype(np.int64)
    parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(low[inside])])
    return parts, np.searchsorted(np.flatnonzero(begins), bounds)


class WordTokens:
    """Ids of texts as little-endian 32-bit numbers.

    The tokenizer drops white space and never joins across it, nor where :func:`pieces` cuts words, so a
    text's ids are those of its pieces one after another.  Pieces are remembered as Arrow and numpy arrays;
    when there are too many, those of the texts at hand stay.
    """

    remembered = 200_000

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = byte_letters()
        self.known = pa.array([], pa.large_binary())
        #: Ids of the known pieces one after another, and where those of each begin and at last end.
        self.ids, self.ends = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where those of each begin and at last end; a null is empty.

        Only pieces that are not known are looked up, each once; the ids of each occurrence are copied from theirs.
        """
        parts, first = pieces(texts)
        found = pc.index_in(parts, value_set=self.known)
        lost = np.flatnonzero(found.is_null().to_numpy(zero_copy_only=False))
        at = pc.fill_null(found, 0).to_numpy().astype(np.int64)
        if len(lost):
            coded = parts.take(pa.array(lost)).dictionary_encode()
            at[lost] = len(self.known) + coded.indices.to_numpy()
            self._learn(coded.dictionary)
        count = np.diff(self.ends)[at]
        ends = np.concatenate([[0], np.cumsum(count)])
        ids = self.ids[np.repeat(self.ends[at] - ends[:-1], count) + np.arange(ends[-1])]
        if len(lost):
            self._forget(at)
        return ids, ends[first]

    def _learn(self, new: pa.Array) -> None:
        own = [self._encode(piece.decode()) for piece in new.to_pylist()]
        self.known = pa.concat_arrays([self.known, new])
        self.ends = np.append(self.ends, self.ends[-1] + np.cumsum([len(x) for x in own]))
        self.ids = np.append(self.ids, np.array([i for x in own for i in x], np.uint32))

    def _forget(self, used: np.ndarray) -> None:
        """Long pieces always, and beyond ``remembered`` those that are not ``used``, or else as many as are too many."""
        short = pc.binary_length(self.known).to_numpy() <= 64
        if len(short) <= self.remembered and short.all():
            return
        keep = np.unique(used)[: self.remembered // 2] if len(short) > self.remembered else np.arange(len(short))
        keep = keep[short[keep]]
        count = np.diff(self.ends)[keep]
        ends = np.concatenate([[0], np.cumsum(count)])
        self.ids = self.ids[np.repeat(self.ends[keep] - ends[:-1], count) + np.arange(ends[-1])]
        self.known, self.ends = self.known.take(pa.array(keep)), ends

    def _encode(self, piece: str) -> list[int]:
        low = piece.lower()
        if low.isalpha() and (low.isascii() or max(low) < "ɐ" and unicodedata.is_normalized("NFC", low)):
            spelled = low if low.isascii() else low.encode().decode("latin-1").translate(self.letters)
            return [t.id for t in self.tokenizer.model.tokenize(spelled)]
        return self.tokenizer.encode(piece, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """One per Python worker, which keeps what it remembers from task to task."""
    return WordTokens(path)
