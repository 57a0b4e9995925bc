"""Quality classifier: support vectors over n-gram indicators scaled by naive Bayes ratios."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from millrace.llm.labelled import MAX_FITTED, labelled_sample
from millrace.llm.text import Words, bounded, paired, texts_of

#: Runs of letters, digits and bytes beyond ASCII, or runs of other signs.
_TOKEN = re.compile(rb"[0-9A-Za-z_\x80-\xff]+|[^\s0-9A-Za-z_\x80-\xff]+")

BITS = 18
_ALONE = np.array([1], np.uint64)
_REPEATED = paired(np.array([2, 2], np.uint64), np.array([3, 4], np.uint64))
_BATCH_BYTES = 16 << 20


def ngrams(texts: list[bytes], bits: int = BITS) -> list[np.ndarray]:
    """For each text the distinct buckets of its tokens and pairs of adjacent tokens.

    A token that equals the one before it counts as one more token, the same for all of them,
    and so has n-grams of its own: one sign for a repetition, one for two in a row.
    """
    words = Words()
    numbers = [words.numbers(_TOKEN.findall(t)) for t in texts]
    hashes = words.hashes()
    shift = np.uint64(64 - bits)
    found = []
    for at in numbers:
        h = hashes[at]
        again = h[1:] == h[:-1]
        runs = [again.any(), (again[1:] & again[:-1]).any()]
        both = np.concatenate([paired(h, _ALONE), paired(h[:-1], h[1:]), _REPEATED[runs]])
        found.append(np.unique(both >> shift).astype(np.int32))
    return found


@dataclass
class Classifier:
    """Weights and squared scales by bucket, and the line from a margin to the log odds."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, found: list[np.ndarray]) -> np.ndarray:
        sums = [self.weights[f].sum() / max(float(np.sqrt(self.squares[f].sum())), 1e-9) for f in found]
        return np.array(sums, float) + self.bias

    def scores(self, found: list[np.ndarray]) -> np.ndarray:
        margin = self.margins(found)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500)))


def log_count_ratios(found: list[np.ndarray], y: np.ndarray, size: int, smoothing: float = 1.0) -> np.ndarray:
    """The log of each bucket's share of class 1 over its share of class 0, by documents."""
    ones = np.full(size, smoothing)
    zeros = np.full(size, smoothing)
    for f, label in zip(found, y):
        (ones if label else zeros)[f] += 1
    return np.log(ones / ones.sum()) - np.log(zeros / zeros.sum())


def dual_descent(
    found: list[np.ndarray], scale: np.ndarray, y: np.ndarray, *, cost: float, epochs: int = 50, tolerance: float = 0.01
) -> tuple[np.ndarray, float]:
    """Minimise |w|^2 / 2 + cost * sum of hinge losses, one dual variable after the other.

    Row i is `scale` at the buckets `found[i]`, divided by its length so that short and long
    texts compare, with a constant 1 for the bias. Both classes
    carry the same total cost. It ends when no dual variable's projected gradient exceeds
    `tolerance`, or after `epochs` rounds over all rows.
    """
    n = len(found)
    sign = np.where(y > 0, 1.0, -1.0)
    share = np.where(y > 0, (y > 0).mean(), (y <= 0).mean())
    most = cost * 0.5 / np.maximum(share, 1e-9)
    w, bias, alpha = np.zeros(len(scale)), 0.0, np.zeros(n)
    values = [scale[f] / max(float(np.linalg.norm(scale[f])), 1e-9) for f in found]
    norms = np.array([v @ v + 1.0 for v in values])
    order = np.random.default_rng(7)
    for _ in range(epochs):
        worst = 0.0
        for i in order.permutation(n):
            f, v = found[i], values[i]
            gradient = sign[i] * (w[f] @ v + bias) - 1
            step = min(max(alpha[i] - gradient / norms[i], 0.0), most[i]) - alpha[i]
            if step:
                worst = max(worst, abs(gradient))
                alpha[i] += step
                w[f] += step * sign[i] * v
                bias += step * sign[i]
        if worst < tolerance:
            break
    return w, bias


def calibrated(margin: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic regression of the label on the margin, by Newton steps.

    Targets are drawn in a little from 0 and 1, so that separable margins have a solution.
    """
    ones, zeros = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    theta = np.array([1.0, 0.0])
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -500, 500)))
        gradient = x.T @ (p - target) + 1e-6 * theta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        theta = theta - step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return float(max(theta[0], 1e-3)), float(theta[1])


def fit(found: list[np.ndarray], y: np.ndarray, *, bits: int = BITS, cost: float = 1.0, folds: int = 3) -> Classifier:
    """Margins for the calibration come from folds that the rows had no part in."""
    size = 1 << bits
    if len(y) == 0 or y.min() == y.max():
        return Classifier(np.zeros(size), np.zeros(size), 0.0, 1.0, float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))

    def learn(rows: np.ndarray) -> Classifier:
        part, labels = [found[i] for i in rows], y[rows]
        ratio = log_count_ratios(part, labels, size)
        w, bias = dual_descent(part, ratio, labels, cost=cost)
        return Classifier(ratio * w, ratio**2, bias, 1.0, 0.0)

    margin = np.zeros(len(y))
    fold = np.random.default_rng(11).permutation(len(y)) % folds
    for k in range(folds):
        rest = np.flatnonzero(fold == k)
        margin[rest] = learn(np.flatnonzero(fold != k)).margins([found[i] for i in rest])
    whole = learn(np.arange(len(y)))
    whole.slope, whole.offset = calibrated(margin, y)
    return whole


def fit_quality_classifier(
    documents: DataFrame,
    labels: DataFrame,
    *,
    fits: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_rows: int = MAX_FITTED,
    bits: int = BITS,
) -> Classifier:
    """Fitted on a sample of `max_rows` labelled documents; the driver gets bucket numbers only.

    Without labels of both classes every text gets the same score.
    """
    sample = labelled_sample(documents, labels, key=key, text=text, label=label, fits=fits, max_rows=max_rows)
    schema = f"{key} {sample.schema[key].dataType.simpleString()}, label int, x binary"

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bounded(whole, text, _BATCH_BYTES):
                x = [f.tobytes() for f in ngrams(texts_of(batch.column(text)), bits)]
                columns = [batch.column(key), batch.column("label"), pa.array(x, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "label", "x"])

    rows = sorted(sample.mapInArrow(measure, schema).collect())
    return fit([np.frombuffer(r["x"], np.int32) for r in rows], np.array([r["label"] for r in rows], int), bits=bits)


def quality_scores(
    documents: DataFrame, classifier: Classifier, *, key: str = "doc_id", text: str = "text", threshold: float = 0.7
) -> DataFrame:
    """`key`, score (0 to 1, higher: label 1 likelier) and predicted (1 from `threshold` on).

    Null and empty texts have no n-grams and get the score of the bias alone. Every row is
    scored by itself: repeated rows stay, and other columns may have any name.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vars(classifier))
    bits = int(len(classifier.weights)).bit_length() - 1
    schema = f"`{key}` {documents.schema[key].dataType.simpleString()}, score double, predicted int"

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(**shared.value)
        for whole in batches:
            for batch in bounded(whole, text, _BATCH_BYTES):
                score = model.scores(ngrams(texts_of(batch.column(text)), bits))
                columns = [batch.column(key), pa.array(score), pa.array((score >= threshold).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "score", "predicted"])

    return documents.select(key, text).mapInArrow(judge, schema)
