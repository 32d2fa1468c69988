"""Language identification by averaged subword embeddings.

A text is the average of the embeddings of its words' subwords, found by hashing, under a linear
softmax; both are trained by stochastic gradient descent in numpy on a bounded sample.  Scores are
calibrated on documents that the descent did not see, and so is the score under which a text is rejected.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listing_lake.llm import words
from listing_lake.llm.tables import written

UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Settings:
    train_rows: int = 6000  #: labelled documents in the sample, dealt equally to the languages
    train_words: int = 400  #: of each of them, taken evenly from its whole text
    buckets: int = 1 << 15
    width: int = 16
    subwords: tuple[int, ...] = (2, 3, 4)
    epochs: int = 6
    rate: float = 2.0
    #: Part of the sample that calibrates, and part of its right answers that may be rejected.
    calibrate: float = 0.2
    refuse: float = 0.001
    most_threshold: float = 0.5  #: a text with a score beyond it is never rejected
    seed: int = 11


@dataclass
class Model:
    languages: list[str]
    embed: np.ndarray  #: a row per bucket
    linear: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float
    subwords: tuple[int, ...]


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 4


def subwords(word: str, sizes: tuple[int, ...], buckets: int) -> list[int]:
    """Buckets of the word, marked at both ends, and of its parts."""
    marked = f"<{word}>"
    parts = [marked[i : i + n] for n in sizes for i in range(len(marked) - n + 1)]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % buckets for p in [marked, *parts]]


def letters(text: str) -> list[str]:
    return [w for w in _WORD.findall(text.lower()) if any(map(str.isalpha, w))]


def _sample(docs: DataFrame, s: Settings) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Language, buckets and how often each occurs, of a sample of about ``train_rows`` rows and never twice as many.

    Each language has an equal share of it, whatever their number.  Words are hashed where the rows are.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold() != 2))
    counted = written(labelled.groupBy("lang").count(), "languages")
    found = counted.count()
    if not found:
        return []
    share = counted.select("lang", F.least(F.lit(1.0), s.train_rows / found / F.col("count")).alias("share"))
    chance = F.pmod(F.xxhash64("doc_id", "text", F.lit(s.seed)), F.lit(1 << 40)) / float(1 << 40)
    picked = labelled.select("lang", "text", chance.alias("chance")).join(share, "lang").filter("chance < share")
    narrow = np.int16 if s.buckets <= 1 << 15 else np.int32

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[int]] = {}
        for batch in words.chunks(batches, "text"):
            own, times = [], []
            for text in batch.column("text").to_pylist():
                if len(known) > 50_000:
                    known.clear()
                all_, parts = letters(text), []
                step = max(1.0, len(all_) / s.train_words)
                for word in (all_[int(i * step)] for i in range(min(len(all_), s.train_words))):
                    if word not in known:
                        known[word] = subwords(word, s.subwords, s.buckets)
                    parts += known[word]
                bucket, n = np.unique(np.array(parts, np.int32), return_counts=True)
                own.append(bucket.astype(narrow))
                times.append(n.astype(np.int32))
            lists = pa.array(own, pa.list_(pa.from_numpy_dtype(narrow))), pa.array(times, pa.list_(pa.int32()))
            yield pa.record_batch([batch.column("lang"), *lists], ["lang", "bucket", "n"])

    kind = "smallint" if narrow is np.int16 else "int"
    rows = picked.select("lang", "text").mapInArrow(hashed, f"lang string, bucket array<{kind}>, n array<int>").limit(2 * s.train_rows).toArrow()
    out = []
    for part in rows.to_batches():
        for lang, bucket, n in zip(*(part.column(c) for c in ("lang", "bucket", "n"))):
            if len(bucket.values):
                out.append((lang.as_py(), bucket.values.to_numpy(), n.values.to_numpy()))  # views of what was fetched
    return sorted(out, key=lambda x: (x[0], x[1].tobytes()))


def train(docs: DataFrame, s: Settings = Settings()) -> Model | None:
    """A model from the labelled documents outside fold 2, or None if there are none."""
    sample = _sample(docs, s)
    if not sample:
        return None
    languages = sorted({lang for lang, _, _ in sample})
    number = {lang: i for i, lang in enumerate(languages)}
    examples = [(bucket, n, number[lang]) for lang, bucket, n in sample]
    rng = np.random.default_rng(s.seed)
    order = rng.permutation(len(examples))
    held = order[: int(len(order) * s.calibrate)] if len(order) >= 10 else order
    fit = order[int(len(order) * s.calibrate) :] if len(order) >= 10 else order
    embed = rng.normal(0, 0.1, (s.buckets, s.width)).astype(np.float32)
    linear = rng.normal(0, 0.1, (s.width, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps, done = s.epochs * len(fit), 0
    for _ in range(s.epochs):
        for i in rng.permutation(fit):
            bucket, n, label = examples[i]
            part = (n / n.sum()).astype(np.float32)
            rate = s.rate * (1 - done / steps)
            done += 1
            middle = part @ embed[bucket]
            wrong = _softmax(middle @ linear + bias)
            wrong[label] -= 1
            back = linear @ wrong
            linear -= rate * 0.1 * np.outer(middle, wrong)
            bias -= rate * 0.01 * wrong
            # in an average over many subwords each moves little, so the step is scaled by their number
            embed[bucket] -= rate * min(len(bucket), 50) * part[:, None] * back
    raw = np.array([examples[i][1] @ embed[examples[i][0]] / examples[i][1].sum() @ linear + bias for i in held])
    label = np.array([examples[i][2] for i in held])
    temperature = min((0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=lambda t: -np.log(_softmax(raw / t)[np.arange(len(held)), label] + 1e-12).sum())
    p = _softmax(raw / temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == label]
    threshold = min(s.most_threshold, float(np.quantile(right, s.refuse))) if len(right) else 0.0
    return Model(languages, embed, linear, bias, float(temperature), threshold, s.subwords)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Scorer:
    """Scores whole texts; remembers the sum of a word's embeddings, for so many words."""

    remembered = 200_000

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.table = np.zeros((1024, self.model.embed.shape[1] + 1), np.float32)

    def _add(self, word: str) -> int:
        bucket = subwords(word, self.model.subwords, len(self.model.embed)) if any(map(str.isalpha, word)) else []
        at = len(self.index)
        if at == len(self.table):
            self.table = np.vstack([self.table, np.zeros_like(self.table)])
        self.table[at, :-1], self.table[at, -1] = self.model.embed[bucket].sum(axis=0), len(bucket)
        self.index[word] = at
        return at

    def __call__(self, text: str | None) -> tuple[str, float]:
        """The language and its score; ``und`` and 0 for a text without a letter."""
        if len(self.index) > self.remembered:
            self._clear()
        total = np.zeros(self.table.shape[1])
        get, at = self.index.get, []
        for word in _WORD.findall((text or "").lower()):
            i = get(word)
            at.append(self._add(word) if i is None else i)
        if at:
            total = self.table[at].sum(axis=0, dtype=np.float64)
        if not total[-1]:
            return UNKNOWN, 0.0
        p = _softmax((total[:-1] / total[-1] @ self.model.linear + self.model.bias) / self.model.temperature)
        best = int(p.argmax())
        return self.model.languages[best], float(p[best])


#: The scorer of a Python worker, which keeps the words it knows from task to task.
_KEPT: list[Scorer] = []


def _scorer(model: Model) -> Scorer:
    same = _KEPT and _KEPT[0].model.languages == model.languages and all(
        np.array_equal(getattr(_KEPT[0].model, f), getattr(model, f)) for f in ("embed", "linear", "bias")
    )
    if not same or _KEPT[0].model.temperature != model.temperature:
        _KEPT[:] = [Scorer(model)]
    return _KEPT[0]


def _judged(docs: DataFrame, model: Model | None, kept_only: bool, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model) if model else None
        least = model.threshold if model else 0.0
        for batch in words.chunks(batches, "text"):
            found = [scorer(t) if scorer else (UNKNOWN, 0.0) for t in batch.column("text").to_pylist()]
            refused = pa.array([lang == UNKNOWN or score < least for lang, score in found], pa.bool_())
            if kept_only:
                yield batch.filter(pa.compute.invert(refused))
                continue
            rest = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "text"]
            names = [n for n in batch.schema.names if n != "text"] + ["lang_pred", "score", "rejected"]
            lang, score = pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())
            yield pa.record_batch([*rest, lang, score, refused], names)

    return docs.mapInArrow(run, schema)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``rejected``.

    Only the text is looked at.  A text that is null or has no letter is ``und`` with score 0 and
    rejected, so is every text when there is no model; ``rejected`` also holds under the calibrated
    score.  A null id is not held out, repeated rows are judged alike, an empty table gives an empty result.
    """
    held = F.coalesce(fold() == 2, F.lit(False)).alias("held_out")
    return _judged(docs.select("doc_id", held, "text"), model, False, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs``, with all columns, that :func:`predict` does not reject."""
    return _judged(docs, model, True, docs.schema)
