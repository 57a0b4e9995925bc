"""Katz backoff language model: counts, weights and scores over chunks of a corpus."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.exchange import (
    REQUEST,
    answers,
    asked,
    batch_of,
    bucket_count,
    chunked,
    from_planes,
    joined,
    planes,
    received,
    unpacked,
)
from millrace.llm.storage import written
from millrace.llm.text import Words, mixed, paired

#: Counts above this are not discounted.
DISCOUNTED = 5
#: Additive smoothing of the base score.
ADDED = 0.1
_START, _END = b"\n<", b"\n>"  # no word holds a line feed
_COUNT_BYTES = 6  # of a count in an answer
_CONTEXTS = 100  # kinds of questions about contexts: this plus the order
_OWN = 200  # kinds of reports on n-grams that are in no other chunk: this plus the order


def discounts(n: list[float], k: int = DISCOUNTED) -> np.ndarray:
    """Good-Turing discount ratios for counts 1 to k, from how many n-grams occur 1, 2, .. k + 1 times.

    Where these ratios do not lie between 0 and 1, which takes a small or odd corpus, counts of 1
    to k lose one absolute amount instead, n1 / (n1 + 2 n2), or half if that is 0 or 1.
    """
    n1, n2 = n[0], n[1]
    if n1 > 0 and all(n[r] > 0 for r in range(k + 1)):
        edge = (k + 1) * n[k] / n1
        if edge < 1:
            r = np.arange(1, k + 1)
            turned = (r + 1) * np.array(n[1 : k + 1]) / np.array(n[:k]) / r
            ratio = (turned - edge) / (1 - edge)
            if ((ratio > 0) & (ratio < 1)).all():
                return ratio
    lost = n1 / (n1 + 2 * n2) if n1 else 0.5
    lost = lost if 0 < lost < 1 else 0.5
    return 1 - lost / np.arange(1, k + 1)


class Model:
    """What all chunks need of the corpus: some numbers for each order."""

    def __init__(self, order: int, counted: dict[int, list[float]]) -> None:
        self.order = order
        self.discounts = {}
        for k in range(1, order + 1):
            self.discounts[k] = discounts(counted.get(k, [0.0] * (DISCOUNTED + 3))[2:])
        self.tokens, self.types = counted.get(1, [0.0, 0.0])[:2]
        # What the discounts take from single tokens is the probability of all unknown ones.
        taken = 0.0
        for r, ratio in enumerate(self.discounts[1], 1):
            taken += (1 - ratio) * r * counted.get(1, [0.0] * (DISCOUNTED + 3))[1 + r]
        self.scale = 1.0 if taken > 0 else self.tokens / (self.tokens + 1)
        self.unknown = taken / self.tokens if taken > 0 else 1 / (self.tokens + 1)

    def kept(self, k: int, counts: np.ndarray) -> np.ndarray:
        """Counts after the discount."""
        low = np.clip(counts, 1, DISCOUNTED).astype(np.int64) - 1
        return counts * np.where((counts > 0) & (counts <= DISCOUNTED), self.discounts[k][low], 1.0)


def _numbered(texts: list[bytes], order: int) -> bytes:
    """A chunk as numbers: tokens of each document, start marks and end among them, keys of the
    distinct tokens, the most frequent first, and for every token the place of its key."""
    words, pad = Words(), [_START] * (order - 1)
    parts = [words.numbers([*pad, *t.lower().split(), _END]) for t in texts]
    keys, place = np.unique(mixed(words.hashes()), return_inverse=True)
    tokens = place[np.concatenate([np.zeros(0, np.int32), *parts])]
    often = np.argsort(-np.bincount(tokens, minlength=len(keys)), kind="stable")
    rank = np.empty(len(keys), np.uint32)
    rank[often] = np.arange(len(keys))
    lengths = np.array([len(p) for p in parts], np.int64)
    head = np.array([len(lengths), len(keys)], np.int64)
    return b"".join([head.tobytes(), lengths.tobytes(), keys[often].tobytes(), planes(rank[tokens]).tobytes()])


class _Grams:
    """Distinct n-grams of a chunk up to an order, numbered by their sorted keys.

    `order` is that of the model, which decides on the start marks; n-grams are made `upto` theirs.
    """

    def __init__(self, blob: bytes, trained: np.ndarray, order: int, upto: int) -> None:
        data = unpacked(blob)
        documents, types = np.frombuffer(data, np.int64, 2).tolist()
        lengths = np.frombuffer(data, np.int64, documents, 16)
        hashes, number = np.unique(np.frombuffer(data, np.uint64, types, 16 + 8 * documents), return_inverse=True)
        token = number[from_planes(data[16 + 8 * (documents + types) :], np.uint32)]
        self.sizes = lengths - (order - 1)
        place = np.arange(len(token)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        real = place >= order - 1
        self.document = np.repeat(np.arange(documents), lengths)[real]
        teaches = np.repeat(trained, lengths)
        trains = teaches & real
        self.keys, self.at = {1: hashes}, {1: token}
        self.context, self.suffix, self.there, self.counts, self.held = {}, {}, {}, {}, {}
        self.known = {}  # what `_counts` made of the answers
        for k in range(1, upto + 1):
            if k > 1:
                before = np.concatenate([[0], self.at[k - 1][:-1]])
                # Places with too few tokens before them have no n-gram; they share the key 0.
                key = np.where(place >= k - 1, paired(self.keys[k - 1][before], hashes[token]), np.uint64(0))
                by_key = np.argsort(key)
                key = key[by_key]
                new = np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]
                self.at[k] = np.empty(len(key), np.int64)
                self.at[k][by_key] = np.cumsum(new) - 1
                self.keys[k], some = key[new], by_key[new]
                self.there[k] = self.keys[k] != 0
                self.context[k], self.suffix[k] = before[some], self.at[k - 1][some]
            n = len(self.keys[k])
            self.counts[k] = np.bincount(self.at[k][trains], minlength=n).astype(float)
            self.held[k] = np.bincount(self.at[k][~teaches], minlength=n).astype(float)
        self.at = {k: a[real] for k, a in self.at.items()}


def _alone(g: _Grams, found: list[dict], k: int) -> np.ndarray:
    """Which n-grams of order k are in no other chunk, as counts of the order below tell.

    Where all training places of an n-gram are in this chunk, and no held-out text holds it, the
    same is true of every longer one that begins or ends with it. Nobody has to be asked about these.
    Start marks by themselves have no count, which says nothing about where they are.
    """
    if k < 3:
        return np.zeros(len(g.keys[k]), bool)
    counts, _, held = _counts(g, found, k - 1)
    here = (counts > 0) & (counts == g.counts[k - 1]) & (held == 0)
    return g.there[k] & (here[g.context[k]] | here[g.suffix[k]])


def _counts(g: _Grams, found: list[dict], k: int) -> list[np.ndarray]:
    """By key: counts in the corpus, whether this chunk is the first to ask, whether held-out texts hold it."""
    if k not in g.known:
        asked_for = ~_alone(g, found, k)
        *digits, flags = received(found, k, [np.uint8] * (_COUNT_BYTES + 1))
        counts, first, held = g.counts[k].copy(), np.ones(len(asked_for), np.uint8), np.zeros(len(asked_for), np.uint8)
        counts[asked_for] = sum(d.astype(np.float64) * 256.0**i for i, d in enumerate(digits))
        first[asked_for], held[asked_for] = flags & 1, flags >> 1
        g.known[k] = [counts, first, held]
    return g.known[k]


def _often(counts: np.ndarray) -> list[float]:
    """Of counts by n-gram: tokens, types and how many occur 1, 2, .. times."""
    often = np.bincount(np.minimum(counts, DISCOUNTED + 2).astype(np.int64), minlength=DISCOUNTED + 3)
    return [float(counts.sum()), float((counts > 0).sum()), *map(float, often[1:])]


def _reported(k: int, chunk: int, counts: np.ndarray, buckets: int) -> Iterator[tuple]:
    """What `_often` says of the n-grams that nobody else is asked about, for a bucket that depends on the chunk."""
    numbers = np.array(_often(counts))
    start = mixed(np.array([chunk], np.uint64)) & ~np.uint64(15)
    return asked(_OWN + k, chunk, start + np.arange(len(numbers), dtype=np.uint64), [numbers], buckets, coded=True)


def _open(counts: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Which contexts have to be asked about.

    A context that trained 1 to `DISCOUNTED` times has no successor that is too frequent for a
    discount, and its own count is that of its successors; unless held-out texts hold it, no
    unseen successor needs its backoff weight. Start marks have no count of their own.
    """
    return (counts == 0) | (counts > DISCOUNTED) | (held > 0)


def _probabilities(g: _Grams, model: Model, found: list[dict], upto: int):
    """By order: the probability of each of the chunk's n-grams, and its count in the corpus.

    Unseen n-grams of contexts that are not `_open` have none; no text holds them.
    """
    chance, total = {}, {}
    for k in range(1, upto + 1):
        total[k] = _counts(g, found, k)[0]
        kept = model.kept(k, total[k])
        if k == 1:
            seen = model.scale * kept / max(model.tokens, 1)
            chance[1] = np.where(total[1] > 0, seen, model.unknown)
            continue
        whole, _, held = _counts(g, found, k - 1)
        asked_for, whole, left = _open(whole, held), whole.copy(), np.ones(len(whole))
        whole[asked_for], left[asked_for] = received(found, _CONTEXTS + k, [np.float64, np.float64])
        at = g.context[k]
        backed = left[at] * chance[k - 1][g.suffix[k]]
        chance[k] = np.where(total[k] > 0, kept / np.maximum(whole[at], 1e-300), backed)
    return chance, total


def _asking(model: Model, weighs: int, counts: list[int], order: int, buckets: int):
    """Questions about the weights of order `weighs`, if it is not 0, and the counts of some orders.

    For weights each n-gram is summed up by the one chunk that asked for its count first.
    """

    def contexts(g: _Grams, found: list[dict]) -> tuple[np.ndarray, list[np.ndarray]]:
        chance, _ = _probabilities(g, model, found, weighs - 1)
        found_counts, owner, _ = _counts(g, found, weighs)
        own = g.there[weighs] & (found_counts > 0) & (owner > 0)
        counts = np.where(own, found_counts, 0.0)
        lower = np.where(own, chance[weighs - 1][g.suffix[weighs]], 0.0)
        keys = g.keys[weighs - 1]
        total, _, held = _counts(g, found, weighs - 1)
        at, sent = g.context[weighs], _open(total, held)
        # Backoff weights are for unseen successors, which only held-out texts have.
        lower = np.where(held[at] > 0, lower, 0.0)
        unseen = g.there[weighs] & (found_counts == 0)
        sums = [np.bincount(at, x, len(keys))[sent] for x in (counts, model.kept(weighs, counts), lower, unseen)]
        return keys[sent], sums

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                g = _Grams(row["texts"], np.array(row["trained"], bool), order, max(weighs, *counts, 1))
                rows = []
                if weighs:
                    rows += asked(_CONTEXTS + weighs, row["chunk"], *contexts(g, row["found"]), buckets, coded=True)
                for k in counts:
                    alone = _alone(g, row["found"], k)
                    rows += asked(k, row["chunk"], g.keys[k][~alone], [g.counts[k][~alone], g.held[k][~alone]], buckets, coded=True)
                    if alone.any():
                        rows += _reported(k, row["chunk"], g.counts[k][alone], buckets)
                yield batch_of(rows, REQUEST)

    return ask


def _answered(kind: int, inverse: np.ndarray, sums: np.ndarray, first: np.ndarray, own: np.ndarray):
    if kind > _OWN:
        return [], sums[0].reshape(-1, DISCOUNTED + 4).sum(axis=0).tolist()
    return _weighed(inverse, sums, own) if kind > _CONTEXTS else _counted(inverse, sums, first)


def _counted(inverse: np.ndarray, sums: np.ndarray, first: np.ndarray):
    """Counts in the whole corpus; tokens, types and how many occur 1, 2, .. times."""
    counts, held = sums
    flags = first.astype(np.uint8) | ((held > 0)[inverse].astype(np.uint8) << 1)
    digits = planes(counts.astype(np.uint64)[inverse])[:_COUNT_BYTES]
    return [*digits, flags], _often(counts)


def _weighed(inverse: np.ndarray, sums: np.ndarray, own: np.ndarray):
    """For each context the count that kept counts are divided by, and the backoff weight.

    Chunks without an unseen successor of the context get 1 for the weight, which they do not need.

    Seen and unseen successors add up to 1 exactly. A context whose counts are all too large for
    a discount keeps one count in its number plus one back for unseen successors. A context
    never seen leaves everything to the lower order.
    """
    counts, kept, lower, _ = sums
    none = counts - kept <= 1e-9 * counts
    whole = np.where(none, counts + 1, counts)
    left = (1 - kept / np.maximum(whole, 1)) / np.maximum(1 - lower, 1e-12)
    left = np.where(counts > 0, left, 1.0)
    return [whole[inverse], np.where(own[3] > 0, left[inverse], 1.0)], []


def _scoring(model: Model, key: str):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                trained = np.array(batch.column("trained")[i].as_py(), bool)
                g = _Grams(batch.column("texts")[i].as_py(), trained, model.order, model.order)
                chance, total = _probabilities(g, model, batch.column("found")[i].as_py(), model.order)
                n = len(g.sizes)
                log = np.log10(chance[model.order])[g.at[model.order]]
                counts = total[1][g.at[1]]
                base = np.log10((total[1] + ADDED) / (model.tokens + ADDED * (model.types + 1)))[g.at[1]]
                arrays = [batch.column(key)[i].values, pa.array(~trained), pa.array(g.sizes)]
                arrays.append(pa.array(np.bincount(g.document, counts > 0, n).astype(np.int64)))
                arrays.append(pa.array(np.full(n, int(model.tokens))))
                arrays.append(pa.array(np.bincount(g.document, base, n)))
                arrays.append(pa.array(np.bincount(g.document, log, n)))
                yield pa.RecordBatch.from_arrays(arrays, names=[key, *_SCORED])

    return score


_SCORED = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def score_texts(
    documents: DataFrame, *, trains: Column, key: str = "doc_id", text: str = "text", order: int = 2
) -> DataFrame:
    """Log probabilities (base 10) of all whole texts under a model of the texts that train.

    Tokens are the words, A-Z lower-cased, and one end; the first ones have start marks before
    them. P(w | h) of a seen n-gram is its discounted count over that of its context h, of any
    other the weight of h times P(w | h without its first token), down to single tokens; what
    the discounts take from these is the probability of all unknown tokens together.

    Returns `key`, held_out (where `trains` does not hold), n_tokens, n_known (tokens that
    occur in training texts), train_tokens, base_score (single tokens with 0.1 added to each
    count) and score. Null and empty texts consist of the end alone, repeated rows are texts of
    their own, a null in `trains` is false, and other columns may have any name. Where no text
    trains, every token is unknown.

    Counts of single tokens and pairs are written as a table by bucket and chunk, then the
    weights of each order with the counts of the next; the driver gets a few sums for each order.
    """
    trained = documents.withColumn("trained", F.coalesce(trains, F.lit(False)))
    name = f"katz_chunks_{uuid.uuid4().hex}"
    chunks = chunked(trained, [key, "trained"], text, partial(_numbered, order=order), name)
    buckets = bucket_count(chunks)
    columns = ("chunk", "texts", "trained", "found")
    counted, replies = {}, []
    for weighs, counts in [(0, [1, 2][:order]), *((k, [k + 1][: order - k]) for k in range(2, order + 1))]:
        asking = _asking(Model(max(weighs, 1), counted), weighs, counts, order, buckets)
        requests = joined(chunks, replies).select(*columns).mapInArrow(asking, REQUEST)
        found, sums = answers(requests, _answered, "counts", coded=True)
        for kind, numbers in sums.items():
            k = kind - _OWN if kind > _OWN else kind
            counted[k] = [a + b for a, b in zip(counted.get(k, [0.0] * len(numbers)), numbers)]
        replies.append(found)
    model = Model(order, counted)
    kind = documents.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    scores = written(joined(chunks, replies).select(key, *columns[1:]).mapInArrow(_scoring(model, key), schema), "scores", 1)
    documents.sparkSession.sql(f"DROP TABLE {name}")
    return scores
