"""Toxicity by non-negative positive-unlabelled learning on words and on how often words begin alike."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.llm.samples import MAX_SAMPLE_BYTES, agreed, bounded, fold, sample_texts
from harvestry.llm.workers import map_batches

#: At most so many confirmed and unlabelled documents are learned from.
MAX_POSITIVE, MAX_UNLABELLED = 3000, 7000
#: Words in fewer sampled documents than this are no features of nn_pu() by itself.
MIN_DOCS = 5
#: Beginnings of words, in code points, and the shares of a text's distinct words that begin so which count.
BEGINNINGS, SHARES, LEAST_ALIKE = (5, 6, 7, 8), (0.01, 0.03, 0.08), 2
#: A feature is learned from if so many confirmed documents have it, and this share of them, so many standard errors above that of the unlabelled.
LEAST_DOCS, LEAST_SHARE, LEAST_ERRORS = 3, 0.02, 3.5

_PLAIN = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 128 and not chr(c).isalnum() else c for c in range(256))


def word_set(text: bytes | None) -> set[bytes]:
    """Distinct words of a text in lower case, ASCII marks and spaces between words."""
    if not text:
        return set()
    if not text.isascii():
        text = text.decode("utf-8", "ignore").lower().encode()
    return set(text.translate(_PLAIN).split())


def features(text: bytes | None, wanted: set[bytes] | None = None) -> set[bytes]:
    """The words of a text, and a feature for each share that the words with one beginning make up of them.

    Insults differ from text to text in their endings; where enough of a text's words begin alike,
    the beginning says more than any of them. wanted are the only beginnings to look at, if given.
    """
    out = word_set(text)
    alike: Counter[bytes] = Counter()
    for word in out:
        whole = word if word.isascii() else word.decode("utf-8", "ignore")
        for n in BEGINNINGS:
            if len(whole) <= n:
                break
            start = whole[:n] if whole is word else whole[:n].encode()
            if wanted is None or start in wanted:
                alike[start] += 1
    total = len(out)
    for start, n in alike.items():
        if n >= LEAST_ALIKE:
            out.update(b"%s~%d" % (start, i) for i, share in enumerate(SHARES) if n >= share * total)
    return out


def telling(positives: Iterable[set[bytes]], unlabelled: Iterable[set[bytes]]) -> list[bytes]:
    """The features that confirmed documents have far more often than unlabelled ones, in order."""
    sums, sizes = [], []
    for group in (positives, unlabelled):
        have: Counter[bytes] = Counter()
        size = 0
        for found in group:
            # of the unlabelled only what may be chosen is counted
            have.update(found if not sums else found & sums[0].keys())
            size += 1
        if not sums:
            have = Counter({w: n for w, n in have.items() if n >= max(LEAST_DOCS, LEAST_SHARE * size)})
        sums.append(have)
        sizes.append(size)
    (inside, around), (n_p, n_u) = sums, sizes
    out = []
    for word, n in inside.items():
        share = (around[word] + 1) / (n_u + 2)
        if n / n_p - share >= LEAST_ERRORS * (share * (1 / n_p + 1 / max(n_u, 1))) ** 0.5:
            out.append(word)
    return sorted(out)


@dataclass
class WordModel:
    """score = 1 / (1 + exp(-(bias + sum of the weights of the features present)))."""

    bias: float
    weights: dict[bytes, float]
    beginnings: set[bytes] = field(init=False)

    def __post_init__(self):
        self.beginnings = {w.rpartition(b"~")[0] for w in self.weights if b"~" in w}

    def score(self, text: bytes | None) -> float:
        have = self.weights.keys() & features(text, self.beginnings)
        z = self.bias + sum(sorted(map(self.weights.__getitem__, have)))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def nn_pu(positives: Iterable[Iterable[bytes]], unlabelled: Iterable[Iterable[bytes]], prior: float, steps: int = 240, rate: float = 0.1, l1: float = 1e-3, min_docs: int = MIN_DOCS) -> WordModel:
    """Minimise prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) under the logistic loss.

    R_p(+) and R_p(-) are the mean losses of the positives as positive and as negative, R_u(-) that
    of the unlabelled as negative; the max keeps the estimate of the negatives' risk from going
    under 0, and where it would, the step goes the other way. Proximal steps keep the weights few,
    the more so the fewer positives there are, and the mean of the second half of the points is
    returned, as the steps turn back and forth around the edge. Documents are iterables of distinct
    words; they are numbered as they come, so only numbers are held.
    """
    numbers: dict[bytes, int] = {}
    rows, sizes = [], []
    for group in (positives, unlabelled):
        size = 0
        for words in group:
            rows.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32))
            size += 1
        sizes.append(size)
    n_p, n_u = sizes
    if not n_p or not n_u:
        return WordModel(float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))) if n_p + n_u else -10.0, {})
    n = n_p + n_u
    row_of, cols = np.repeat(np.arange(n, dtype=np.int32), [len(r) for r in rows]), np.concatenate(rows)
    del rows
    counts = np.bincount(cols, minlength=len(numbers))
    index = np.cumsum(counts >= min_docs) - 1
    use = counts[cols] >= min_docs
    row_of, cols = row_of[use], index[cols[use]].astype(np.int32)
    vocabulary = [w for w, c in zip(numbers, counts >= min_docs, strict=True) if c]
    v = len(vocabulary)
    # words that most documents have carry little and would slow the steps down
    scale = 1 / np.sqrt(np.bincount(cols, minlength=v) / n + 1e-3)
    l1 = l1 * max(1.0, (1000 / n_p) ** 0.5)
    w, b = np.zeros(v), float(np.log(prior / (1 - prior)))
    vw, vb = w.copy(), b
    positive = np.arange(n) < n_p
    sum_w, sum_b, half = np.zeros(v), 0.0, steps // 2
    for t in range(steps):
        z = vb + np.bincount(row_of, (vw * scale)[cols], minlength=n)
        s = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        loss = np.logaddexp(0, z)
        g = np.where(positive, -prior * s / n_p, s / n_u)
        g = g + np.where(positive, prior * (s - 1) / n_p, 0.0) if loss[~positive].mean() >= prior * loss[positive].mean() else -g
        new = vw - rate * np.bincount(cols, g[row_of], minlength=v) * scale
        new = np.sign(new) * np.maximum(np.abs(new) - rate * l1, 0)
        nb, mix = vb - rate * g.sum(), min(t / (t + 3), 0.9)
        vw, vb = new + mix * (new - w), nb + mix * (nb - b)
        w, b = new, nb
        if t >= half:
            sum_w += w
            sum_b += b
    w, b = sum_w / (steps - half), sum_b / (steps - half)
    return WordModel(float(b), {x: float(y) for x, y in zip(vocabulary, w * scale, strict=True) if abs(y) >= 1e-3})


def train(
    docs: DataFrame, labels: DataFrame, prior: float | None = None, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, folds: int = 5, max_bytes: int = MAX_SAMPLE_BYTES
) -> WordModel:
    """A model from rows whose fold isn't 0: confirmed toxic documents, and texts without their labels.

    prior is the share of toxic documents; without one, that among labelled training rows. The
    samples are bounded in documents and, together, in bytes of text: in the order of a hash of the
    id, a text that would go beyond max_bytes is left out. Null ids, texts and labels, and ids with
    both labels, are left out; no toxic row at all gives a model that scores everything near 0.
    """
    known = agreed(labels.filter(fold(F.col("doc_id"), folds) > 0), "toxic")
    if prior is None:
        got = known.agg(F.avg("y")).first()[0]
        prior = min(max(got if got is not None else 0.01, 1e-4), 0.9)
    confirmed = bounded(known.filter("y = 1").select("sid"), max_positive).withColumn("kind", F.lit(1))
    others = bounded(docs.select(F.col("doc_id").alias("sid")).filter(fold(F.col("doc_id"), folds) > 0).distinct(), max_unlabelled).withColumn("kind", F.lit(0))
    # both sides have at most max_positive + max_unlabelled rows
    found = sample_texts(docs, confirmed.unionByName(others), max_bytes)
    kinds, bodies = found.column("kind").to_pylist(), found.column("body")
    of = lambda kind, wanted=None: (features(body.as_py(), wanted) for k, body in zip(kinds, bodies, strict=True) if k == kind)
    chosen = telling(of(1), of(0))
    starts = WordModel(0.0, dict.fromkeys(chosen, 0.0)).beginnings
    # one order for every run; texts that repeat each other fall together, whichever came first
    rows = lambda kind: sorted(sorted(x.intersection(chosen)) for x in of(kind, starts))
    return nn_pu(rows(1), rows(0), prior, l1=5e-4, min_docs=1)


def score(docs: DataFrame, model: WordModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id and score of every row; null and empty texts have the model's bias. Other columns aren't read."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([model.score(x.as_py()) for x in batch.column(1)], pa.float64())], ["id", "score"])

    return map_batches(docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary").alias("body")), run, "id long, score double")


def keep_clean(docs: DataFrame, model: WordModel, threshold: float = 0.5) -> DataFrame:
    """docs, all columns and rows as they are, without those that score threshold or more."""
    schema, place = docs.schema, docs.columns.index("text")

    def run(batches):
        for batch in batches:
            keep = [model.score(t.encode() if (t := x.as_py()) is not None else None) < threshold for x in batch.column(place)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return map_batches(docs, run, schema)
