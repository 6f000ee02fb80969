"""Quality classifier: averaged vectors of hashed words and character n-grams, and a softmax."""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.llm.samples import agreed, bounded, fold, sample_texts
from harvestry.llm.workers import map_batches

#: At most so many labelled documents of each class are learned from.
MAX_PER_CLASS = 4000
#: Distinct words kept by a process when scoring; beyond it the table starts anew.
MAX_WORDS = 250_000


def word_features(word: bytes, mask: int, shortest: int = 3, longest: int = 5) -> list[int]:
    """Buckets of a word and of the n-grams of its characters, with < and > at its ends.

    Characters are code points (bytes that are no UTF-8 count as one replacement each), hashed as
    their UTF-8. Very long words are taken as a whole; their n-grams are as many as their characters.
    """
    marked = b"<" + word + b">"
    out = [zlib.crc32(marked, 1) & mask]
    if word.isascii():
        for n in range(shortest, longest + 1):
            out += [zlib.crc32(marked[i : i + n]) & mask for i in range(len(marked) - n + 1)]
        return out
    parts = [c.encode() for c in marked.decode("utf-8", "replace")]
    for n in range(shortest, longest + 1):
        out += [zlib.crc32(b"".join(parts[i : i + n])) & mask for i in range(len(parts) - n + 1)]
    return out


@dataclass
class SubwordModel:
    """vectors[buckets, dim], and the output layer's weights[2, dim] and bias[2]."""

    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    _words: dict = field(default_factory=dict, repr=False)

    def scorer(self):
        """A function from a text's bytes to its score.

        The document vector is a mean, so its logit is a mean over words: a word counts by two
        sums, of its features' logits and of their number, held as one complex number.
        """
        logits = (self.vectors @ (self.weights[1] - self.weights[0])).tolist()
        mask, bias = len(logits) - 1, float(self.bias[1] - self.bias[0])

        class Table(dict):
            def __missing__(table, word):  # noqa: N805
                if len(table) >= MAX_WORDS:
                    table.clear()
                found = word_features(word, mask)
                out = table[word] = complex(sum(map(logits.__getitem__, found)), len(found))
                return out

        table = Table()

        def score(text: bytes | None) -> float:
            total = sum(map(table.__getitem__, text.split())) if text else 0j
            z = bias + (total.real / total.imag if total else 0.0)
            return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))

        return score


def fit(texts: list[bytes], labels: list[int], buckets: int = 1 << 16, dim: int = 8, epochs: int = 6, rate: float = 0.4, seed: int = 11) -> SubwordModel:
    """Stochastic gradient descent, document by document, with a rate that falls to 0.

    The classes weigh the same in the loss as they do in the data. Without documents the score is
    one half everywhere.
    """
    if buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two")
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (buckets, dim))
    weights, bias = np.zeros((2, dim)), np.zeros(2)
    known: dict[bytes, np.ndarray] = {}
    docs = []
    for text in texts:
        parts = []
        for word in text.split():
            if word not in known:
                known[word] = np.array(word_features(word, buckets - 1), np.int64)
            parts.append(known[word])
        if parts:
            ids, counts = np.unique(np.concatenate(parts), return_counts=True)
            docs.append((ids, counts / counts.sum()))
        else:
            docs.append((np.empty(0, np.int64), np.empty(0)))
    steps, t = epochs * len(docs), 0
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            ids, share = docs[i]
            hidden = share @ vectors[ids]
            z = weights @ hidden + bias
            p = np.exp(z - z.max())
            g = p / p.sum()
            g[labels[i]] -= 1
            step = rate * (1 - t / steps)
            t += 1
            back = g @ weights
            weights -= step * np.outer(g, hidden)
            bias -= step * g
            # a feature's share of the mean is small; the usual update gives each the whole gradient over the number of features
            vectors[ids] -= step * np.outer(share * len(ids) ** 0.5, back)
    return SubwordModel(vectors, weights, bias)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_per_class: int = MAX_PER_CLASS, folds: int = 3, held: int = 1, **how) -> SubwordModel:
    """A model from labelled rows outside the held-out fold, at most max_per_class of each class.

    If one class is sampled, the other is sampled by the same factor, so the shares stay. Null
    ids, texts and labels, and ids with both labels, are left out. Only the sample, bounded in
    documents and bytes, comes to the driver.
    """
    remainder = fold(F.col("doc_id"), folds)
    known = agreed(labels.filter((remainder >= 0) & (remainder != held)), label)
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return fit([], [], **how)
    share = min(1.0, max_per_class / max(sizes.values()))
    parts = [bounded(known.filter(F.col("y") == y).select("sid"), max(1, round(n * share))).withColumn("kind", F.lit(y)) for y, n in sorted(sizes.items())]
    # at most 2 * max_per_class rows
    found = sample_texts(docs, parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0])
    rows = sorted(zip(*(found.column(c).to_pylist() for c in ("sid", "body", "kind")), strict=True))
    return fit([r[1] for r in rows], [r[2] for r in rows], **how)


def score(docs: DataFrame, model: SubwordModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id and score (probability of label 1) of every whole text; null, empty: the bias alone."""

    def run(batches):
        one = model.scorer()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([one(x.as_py()) for x in batch.column(1)], pa.float64())], ["id", "score"])

    return map_batches(docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary").alias("body")), run, "id long, score double")
