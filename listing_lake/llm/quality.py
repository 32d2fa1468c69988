"""Document quality by hierarchical empirical Bayes.

A small classifier turns a whole text's measures into evidence: how much likelier the text is if good
than if bad.  What its site is like is the prior: the rate of good documents under its path, shrunk
toward that of its host, itself shrunk toward the rate of all documents.  How strongly to shrink is
estimated from how far sites differ beyond chance.  All rates come from grouped sums over all documents,
without the document that is judged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listing_lake.llm import words
from listing_lake.llm.tables import written

MEASURES = (
    "log words", "mean word length", "distinct words", "repeated neighbours", "commonest word", "distinct triples",
    "letters", "upper case", "digits", "marks", "other signs", "line ends", "long words",
)


@dataclass(frozen=True)
class Settings:
    train_rows: int = 20_000  #: labelled documents the classifier is fitted on, at most twice as many
    rounds: int = 400
    penalty: float = 1e-3
    threshold: float = 0.5
    most_evidence: float = 8.0  #: of one document, either way, in natural logarithms
    seed: int = 5


def _table(values) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


_UPPER, _DIGIT = _table(range(65, 91)), _table(range(48, 58))
_MARK = _table(map(ord, ".,;:!?'\"-"))
_LETTER = _table([*range(65, 91), *range(97, 123), *range(128, 256)])
_LINE = _table([10])


def measures(w: words.Words, bytes_: np.ndarray) -> np.ndarray:
    """A row of :data:`MEASURES` per text; ``bytes_`` are the sizes of the texts."""
    size = np.diff(w.first)
    n, texts = np.maximum(size, 1), len(size)
    doc = w.text_of()
    length = w.ends - w.starts

    def kinds(values: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the valid values of each text: how many there are of different ones, and how often the commonest occurs."""
        d, v = doc[valid], values[valid]
        order = np.lexsort((v, d))
        d, v = d[order], v[order]
        new = np.ones(len(d), bool)
        new[1:] = (d[1:] != d[:-1]) | (v[1:] != v[:-1])
        first = np.flatnonzero(new)
        most = np.zeros(texts)
        np.maximum.at(most, d[first], np.diff(np.append(first, len(d))))
        return np.bincount(d[first], minlength=texts), most

    left = w.left()
    every, most = kinds(w.hashes, np.ones(len(doc), bool))
    triples, _ = kinds(w.windows(3), left >= 3)
    twin = np.zeros(len(doc), bool)
    twin[:-1] = (w.hashes[1:] == w.hashes[:-1]) & (left[:-1] >= 2)
    edges = np.concatenate([[0], np.cumsum(bytes_)])

    def share(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[w.data])])
        return (total[edges[1:]] - total[edges[:-1]]) / np.maximum(bytes_, 1)

    other = ~(_LETTER | _DIGIT | _MARK | _LINE | _table([32]))
    per_text = lambda x: np.bincount(doc, x, texts)
    return np.stack(
        [
            np.log1p(size), per_text(length) / n, every / n, per_text(twin) / n, most / n, triples / np.maximum(size - 2, 1),
            share(_LETTER), share(_UPPER), share(_DIGIT), share(_MARK), share(other), share(_LINE), per_text(length > 20) / n,
        ],
        axis=1,
    )


def _measured(docs: DataFrame, host: Column, path: Column) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.chunks(batches, "text"):
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            found = measures(words.split(batch.column("text")), sizes.astype(np.int64))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * len(MEASURES), pa.int32()), pa.array(found.ravel()))
            yield pa.record_batch([*(batch.column(c) for c in ("doc_id", "host", "path")), flat], ["doc_id", "host", "path", "x"])

    named = docs.select("doc_id", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"), "text")
    return named.mapInArrow(run, "doc_id long, host string, path string, x array<double>")


def _squares(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, x * x], axis=-1)


def fit(x: np.ndarray, y: np.ndarray, s: Settings) -> tuple[np.ndarray, float]:
    """Weights of the measures and their squares, and the constant, of a logistic regression in natural units."""
    z = _squares(x)
    middle, spread = z.mean(axis=0), z.std(axis=0) + 1e-9
    z = (z - middle) / spread
    w, b, slope = np.zeros(z.shape[1]), 0.0, np.full(z.shape[1] + 1, 1e-8)
    for _ in range(s.rounds):
        wrong = 1 / (1 + np.exp(-(z @ w + b))) - y
        g = np.append(z.T @ wrong / len(y) + s.penalty * w, wrong.mean())
        slope += g * g
        step = 0.5 * g / np.sqrt(slope)
        w, b = w - step[:-1], b - step[-1]
    return w / spread, float(b - (w * middle / spread).sum())


def _concentration(sites: DataFrame, prior: Column) -> tuple[float, float]:
    """How many documents a site's prior is worth, by the method of moments; and the rate of all sites."""
    rate = F.col("good") / F.col("n")
    r = sites.agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum("good").alias("good"), F.count("*").alias("k"),
        F.sum(F.col("n") * (rate - prior) * (rate - prior)).alias("spread"),
    ).first()
    if not r["n"]:
        return 1.0, 0.5
    mean = min(max(r["good"] / r["n"], 1e-6), 1 - 1e-6)
    free = r["n"] - r["nn"] / r["n"]
    between = (r["spread"] - (r["k"] - 1) * mean * (1 - mean)) / free if free > 0 else 0.0
    share = min(max(between / (mean * (1 - mean)), 1e-6), 0.999)
    return 1 / share - 1, mean


def judge(docs: DataFrame, labels: DataFrame, host: Column, path: Column, s: Settings = Settings()) -> DataFrame:
    """One row per document: ``doc_id``, ``evidence``, ``host_rate``, ``path_rate``, ``score``, ``kept``.

    ``labels`` has ``doc_id`` and ``quality`` (1 good, 0 bad); a document labelled more than once has the
    mean.  A labelled document counts in its site's rates by its label, any other by its evidence; its own
    score never uses its own label.  A null host or path is an empty one, a null text an empty text, a
    document without id has no label, repeated rows are judged alike.  Without both kinds of labels the
    evidence is 0.  An empty table gives an empty result.
    """
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("label"))
    rows = written(_measured(docs, host, path).join(known, "doc_id", "left"), "measured")
    total = rows.agg(F.count("label").alias("n"), F.avg("label").alias("rate")).first()
    base = min(max(total["rate"] if total["rate"] is not None else 0.5, 1e-3), 1 - 1e-3)
    weights, constant = np.zeros(2 * len(MEASURES)), 0.0
    if total["n"]:
        chance = F.pmod(F.xxhash64("doc_id", F.lit(s.seed)), F.lit(1 << 40)) / float(1 << 40)
        sample = rows.filter("label IS NOT NULL").filter(chance <= s.train_rows / total["n"]).select("doc_id", "x", "label").limit(2 * s.train_rows).collect()
        sample.sort(key=lambda r: (r["doc_id"], r["x"]))
        y = np.array([r["label"] for r in sample])
        if len(y) and y.min() < 0.5 <= y.max():
            weights, constant = fit(np.array([r["x"] for r in sample]), y, s)
            constant -= float(np.log(base / (1 - base)))  # what is left is the likelihood ratio
    parts = [F.col("x")[i] * (float(weights[i]) + float(weights[i + len(MEASURES)]) * F.col("x")[i]) for i in range(len(MEASURES))]
    evidence = F.least(F.greatest(sum(parts, F.lit(constant)), F.lit(-s.most_evidence)), F.lit(s.most_evidence))
    odds = float(np.log(base / (1 - base)))
    rows = rows.select("doc_id", "host", "path", evidence.alias("evidence"), "label")
    rows = rows.withColumn("good", F.coalesce("label", 1 / (1 + F.exp(-(F.col("evidence") + odds)))))

    hosts = rows.groupBy("host").agg(F.count("*").alias("n"), F.sum("good").alias("good"))
    paths = rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("good").alias("good"))
    paths = written(paths.join(hosts.toDF("host", "host_n", "host_good"), "host"), "sites")
    all_ = paths.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    overall = (all_["good"] / all_["n"]) if all_["n"] else 0.5
    k_host, _ = _concentration(paths.select("host", F.col("host_n").alias("n"), F.col("host_good").alias("good")).distinct(), F.lit(overall))
    k_path, _ = _concentration(paths, F.col("host_good") / F.col("host_n"))

    placed = rows.join(paths.toDF("host", "path", "path_n", "path_good", "host_n", "host_good"), ["host", "path"])
    host_rate = (k_host * overall + F.col("host_good") - F.col("good")) / (k_host + F.col("host_n") - 1)
    path_rate = (k_path * F.col("host_rate") + F.col("path_good") - F.col("good")) / (k_path + F.col("path_n") - 1)
    bounded = F.least(F.greatest(F.col("path_rate"), F.lit(1e-6)), F.lit(1 - 1e-6))
    score = 1 / (1 + F.exp(-(F.col("evidence") + F.log(bounded / (1 - bounded)))))
    return (
        placed.withColumn("host_rate", host_rate).withColumn("path_rate", path_rate).withColumn("score", score)
        .select("doc_id", "evidence", "host_rate", "path_rate", "score", (F.col("score") >= s.threshold).alias("kept"))
    )
