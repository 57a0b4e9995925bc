"""Quality rules: gradient-boosted trees over statistics of a document."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from millrace.llm.labelled import MAX_FITTED, labelled_sample
from millrace.llm.text import bounded, texts_of

WINDOW = 5
_BATCH_BYTES = 4 << 20
_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\v\f\r"
_CONTINUATION = bytes(range(0x80, 0xC0))
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LOWER = bytes(range(ord("a"), ord("z") + 1))
_DIGITS = b"0123456789"
_PUNCTUATION = b".,;:!?\"'()-"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: The statistics that trees split on, with the sign that the score may change in as they grow.
FEATURES = {
    "log_words": 0,
    "mean_word_chars": 0,
    "symbols_per_word": -1,
    "dup_lines_share": -1,
    "repeat_words_share": -1,
    "distinct_words_share": 0,
    "most_frequent_word_share": -1,
    "upper_share": -1,
    "digit_share": -1,
    "punctuation_per_word": 0,
    "exclamations_per_word": -1,
    "same_next_word_share": -1,
    "words_per_line": 0,
}


def _held(text: bytes, chars: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows whose word sequence is found twice or more, each word once."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    grams = list(zip(*(words[i:] for i in range(window))))
    if len(set(grams)) == n:
        return 0
    seen = Counter(grams)
    total, end = 0, 0
    for i, g in enumerate(grams):
        if seen[g] > 1:
            total += i + window - max(end, i)
            end = i + window
    return total


def statistics(text: bytes) -> tuple[list[int], list[float]]:
    """The base counts and the features of one whole text."""
    words = text.split()
    n = len(words)
    solid = text.translate(None, _SPACES + _CONTINUATION)
    word_chars = len(solid)
    symbols = _held(text, _SYMBOLS)
    lines = text.split(b"\n")
    full = [x for x in lines if x and not x.isspace()]
    dup_lines = len(full) - len(set(full))
    repeats = repeated_words(words)
    counted = Counter(words)
    per_word, chars = max(n, 1), max(word_chars, 1)
    letters = max(_held(solid, _UPPER + _LOWER), 1)
    same_next = sum(map(bytes.__eq__, words, words[1:]))
    features = [
        float(np.log1p(n)),
        word_chars / per_word,
        symbols / per_word,
        dup_lines / max(len(full), 1),
        repeats / per_word,
        len(counted) / per_word,
        max(counted.values(), default=0) / per_word,
        _held(solid, _UPPER) / letters,
        _held(solid, _DIGITS) / chars,
        _held(solid, _PUNCTUATION) / per_word,
        text.count(b"!") / per_word,
        same_next / per_word,
        n / max(len(full), 1),
    ]
    return [n, word_chars, symbols, dup_lines, repeats], features


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 10 or 100 * n_repeat_words > 20 * n_words


@dataclass
class Trees:
    """All trees of one model in flat arrays; a node's children stand at `left` and `left + 1`.

    A leaf is its own left child, so that every row takes `depth` steps in every tree.
    """

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    depth: int
    start: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            below = self.left[at]
            right = x[rows, self.feature[at]] > self.threshold[at]
            at = np.where(below == at, at, below + right)
        return self.start + self.value[at].sum(axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(x)))


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    signs: np.ndarray,
    *,
    trees: int = 80,
    depth: int = 3,
    rate: float = 0.15,
    bins: int = 64,
    ridge: float = 1.0,
    least_weight: float = 5.0,
) -> Trees:
    """Second-order boosting on the logistic loss over histograms.

    For a feature with sign s a split is taken only if s times the right value is not below s
    times the left one; both children then keep to their side of the middle, so that the whole
    model is monotonic in that feature. Ties between splits go to the first feature and bound.
    """
    n, width = x.shape
    rate_of_ones = (y.sum() + 0.5) / (n + 1) if n else 0.5
    start = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for f in range(width)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(width)], axis=1) if n else x.astype(int)
    margin = np.full(n, start)
    roots, feature, threshold, left, value = [], [], [], [], []

    def node() -> int:
        for column, fill in ((feature, 0), (threshold, 0.0), (left, len(left)), (value, 0.0)):
            column.append(fill)
        return len(left) - 1

    def weight(g: float | np.ndarray, h: float | np.ndarray):
        return -g / (h + ridge)

    for _ in range(trees if n else 0):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        roots.append(node())
        level = [(roots[-1], np.arange(n), -np.inf, np.inf)]
        for step in range(depth + 1):
            below = []
            for at, rows, low, high in level:
                gs, hs = g[rows].sum(), h[rows].sum()
                value[at] = rate * float(np.clip(weight(gs, hs), low, high))
                margin_step = value[at]
                best = None
                for f in range(width) if step < depth else ():
                    if not len(cuts[f]):
                        continue
                    b = binned[rows, f]
                    gl = np.cumsum(np.bincount(b, g[rows], len(cuts[f]) + 1))[:-1]
                    hl = np.cumsum(np.bincount(b, h[rows], len(cuts[f]) + 1))[:-1]
                    gr, hr = gs - gl, hs - hl
                    vl, vr = np.clip(weight(gl, hl), low, high), np.clip(weight(gr, hr), low, high)
                    gain = -(gl * vl + (hl + ridge) * vl**2 / 2 + gr * vr + (hr + ridge) * vr**2 / 2)
                    gain[(hl < least_weight) | (hr < least_weight) | (signs[f] * (vr - vl) < 0)] = -np.inf
                    k = int(np.argmax(gain))
                    if np.isfinite(gain[k]) and (best is None or gain[k] > best[0] + 1e-12):
                        best = (gain[k], f, k, vl[k], vr[k])
                own = weight(gs, hs)
                if best is None or best[0] <= -(gs * own + (hs + ridge) * own**2 / 2) + 1e-9:
                    margin[rows] += margin_step
                    continue
                _, f, k, vl, vr = best
                feature[at], threshold[at] = f, float(cuts[f][k])
                left[at] = node()
                node()
                goes_right = binned[rows, f] > k
                middle = (vl + vr) / 2
                sides = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
                (low_l, high_l), (low_r, high_r) = sides[int(signs[f])]
                below.append((left[at], rows[~goes_right], low_l, high_l))
                below.append((left[at] + 1, rows[goes_right], low_r, high_r))
            level = below
    arrays = (np.array(roots, np.int32), np.array(feature, np.int32), np.array(threshold), np.array(left, np.int32), np.array(value))
    return Trees(*arrays, depth, start)


def fit_quality_trees(
    documents: DataFrame,
    labels: DataFrame,
    *,
    fits: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_rows: int = MAX_FITTED,
) -> Trees:
    """Trees that tell label 1 from 0, fitted on a sample of `max_rows` labelled documents.

    Statistics are computed by the tasks; the driver gets numbers of the sample only. Without
    labelled documents the score is 0.5 for every text.
    """
    sample = labelled_sample(documents, labels, key=key, text=text, label=label, fits=fits, max_rows=max_rows)
    schema = f"{key} {sample.schema[key].dataType.simpleString()}, label int, x binary"

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bounded(whole, text, _BATCH_BYTES):
                x = [np.array(statistics(t)[1]).tobytes() for t in texts_of(batch.column(text))]
                columns = [batch.column(key), batch.column("label"), pa.array(x, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "label", "x"])

    rows = sorted(sample.mapInArrow(measure, schema).collect())
    x = np.array([np.frombuffer(r["x"]) for r in rows]).reshape(-1, len(FEATURES))
    return fit_trees(x, np.array([r["label"] for r in rows], float), np.array(list(FEATURES.values())))


def quality_rules(
    documents: DataFrame, trees: Trees, *, text: str = "text", threshold: float = 0.5, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Statistics, score and verdict of every whole text.

    Returns the columns `keep`, then n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words (long), base_failed, score (of the trees) and kept: false if base_failed,
    else whether the score reaches `threshold`. A null text is an empty one, which fails the
    base. Rows are neither shuffled nor merged, so repeated rows stay, and columns of
    `documents` that are not in `keep` may have any name.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vars(trees))
    names = [*keep, *BASE, "base_failed", "score", "kept"]
    kinds = [documents.schema[c].dataType.simpleString() for c in keep]
    kinds += ["bigint"] * len(BASE) + ["boolean", "double", "boolean"]
    schema = ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds))

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Trees(**shared.value)
        for whole in batches:
            for batch in bounded(whole, text, _BATCH_BYTES):
                found = [statistics(t) for t in texts_of(batch.column(text))]
                base = np.array([b for b, _ in found], np.int64).reshape(-1, len(BASE))
                score = model.scores(np.array([x for _, x in found], float).reshape(-1, len(FEATURES)))
                failed = np.array([base_failed(b[0], b[4]) for b in base], bool)
                columns = [batch.column(c) for c in keep] + [pa.array(base[:, i]) for i in range(len(BASE))]
                columns += [pa.array(failed), pa.array(score), pa.array(~failed & (score >= threshold))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return documents.select(*dict.fromkeys([*keep, text])).mapInArrow(judge, schema)
