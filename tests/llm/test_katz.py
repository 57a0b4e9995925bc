"""Katz scores against counts and weights worked out with dictionaries."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import exchange
from millrace.llm.katz import ADDED, DISCOUNTED, discounts, score_texts

TEXTS = [
    "the cat sat on the mat", "The cat ran", "", None, "a dog sat on the mat the dog sat",
    "the the the the", "new words here only", "the cat sat", "the cat sat", "x " * 300, "a b c d e a b c a b a",
]


def tokens(text, order):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    return ["<s>"] * (order - 1) + words + ["</s>"]


class Brute:
    def __init__(self, texts, order):
        self.order = order
        self.counts = {k: Counter() for k in range(1, order + 1)}
        for t in texts:
            w = tokens(t, order)
            for i in range(order - 1, len(w)):
                for k in self.counts:
                    self.counts[k][tuple(w[i - k + 1 : i + 1])] += 1
        self.n = sum(self.counts[1].values())
        self.ratio = {}
        for k, c in self.counts.items():
            often = Counter(c.values())
            self.ratio[k] = discounts([float(often[r]) for r in range(1, DISCOUNTED + 2)])
        taken = sum(c - self.kept((w,)) for (w,), c in self.counts[1].items())
        self.unknown = taken / self.n if taken > 0 else 1 / (self.n + 1)
        self.scale = 1 if taken > 0 else self.n / (self.n + 1)

    def kept(self, gram):
        c = self.counts[len(gram)][gram]
        return c * self.ratio[len(gram)][c - 1] if 0 < c <= DISCOUNTED else c

    def p(self, gram):
        if len(gram) == 1:
            return self.scale * self.kept(gram) / self.n if self.counts[1][gram] else self.unknown
        h = gram[:-1]
        seen = [g for g in self.counts[len(gram)] if g[:-1] == h]
        whole = sum(self.counts[len(gram)][g] for g in seen)
        if not whole:
            return self.p(gram[1:])
        kept = sum(self.kept(g) for g in seen)
        if whole - kept <= 1e-9 * whole:
            whole += 1
        if gram in seen:
            return self.kept(gram) / whole
        return (1 - kept / whole) / (1 - sum(self.p(g[1:]) for g in seen)) * self.p(gram[1:])


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_dictionaries(spark, order, monkeypatch):
    monkeypatch.setattr(exchange, "CHUNK_BYTES", 40)
    monkeypatch.setattr(exchange, "_BUCKET_BYTES", 300)
    rows = [(i, t, "b", 1) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found string, trained int").repartition(3)
    got = {r["doc_id"]: r for r in score_texts(docs, trains=F.col("doc_id") % 4 != 0, order=order).collect()}
    model = Brute([t for i, t in enumerate(TEXTS) if i % 4], order)
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        w, r = tokens(t, order), got[i]
        own = w[order - 1 :]
        score = sum(math.log10(model.p(tuple(w[j - order + 1 : j + 1]))) for j in range(order - 1, len(w)))
        v = len(model.counts[1])
        base = sum(math.log10((model.counts[1][(x,)] + ADDED) / (model.n + ADDED * (v + 1))) for x in own)
        assert r["held_out"] == (i % 4 == 0)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            len(own), sum(model.counts[1][(x,)] > 0 for x in own), model.n)
        assert r["score"] == pytest.approx(score) and r["base_score"] == pytest.approx(base)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_adds_up_to_one(order):
    model = Brute(TEXTS, order)
    types = {w for (w,) in model.counts[1]} | {"<unknown>"}
    for h in [g[:-1] for g in model.counts[order]][:20]:
        assert sum(model.p((*h, w)) for w in types) == pytest.approx(1)


def test_no_training_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = score_texts(docs, trains=F.lit(False)).orderBy("doc_id").collect()
    assert [(r["score"], r["base_score"], r["train_tokens"], r["n_known"]) for r in got] == [(0, 0, 0, 0)] * 2
    assert score_texts(docs.limit(0), trains=F.lit(True)).count() == 0


def test_discounts():
    good = discounts([100.0, 40.0, 24.0, 17.0, 13.0, 10.0])
    assert ((good > 0) & (good < 1)).all() and good[0] == good.min()
    assert discounts([0.0] * 6)[0] == 0.5
    assert discounts([10.0, 5.0, 0, 0, 0, 0])[0] == pytest.approx(0.5)


@pytest.mark.parametrize("order", [2, 3, 4])
@pytest.mark.parametrize("every", [2, 5, 1000])
def test_ngrams_of_one_chunk_only(spark, order, every, monkeypatch):
    """Texts with passages of their own, shared ones and repeats in one chunk; with every = 1000 only the first is held out."""
    monkeypatch.setattr(exchange, "CHUNK_BYTES", 150)
    monkeypatch.setattr(exchange, "_BUCKET_BYTES", 300)
    rnd = random.Random(order)
    texts = [" ".join(rnd.choices("abcdefghijklmnopqrst", k=rnd.randint(0, 25))) for _ in range(30)]
    texts += [texts[3], texts[7], texts[7] + " a b", "a a a a a a a", "u v w u v w u v w"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    model = Brute([t for i, t in enumerate(texts) if i % every], order)
    for r in score_texts(docs, trains=F.col("doc_id") % every != 0, order=order).collect():
        w = tokens(texts[r["doc_id"]], order)
        score = sum(math.log10(model.p(tuple(w[j - order + 1 : j + 1]))) for j in range(order - 1, len(w)))
        assert r["score"] == pytest.approx(score)


def test_asks_only_what_others_may_know(spark, monkeypatch):
    """Triples that hold a pair of this chunk alone go to nobody, and weights only to chunks with unseen n-grams."""
    monkeypatch.setattr(exchange, "CHUNK_BYTES", 400)
    asked, weights = {}, []

    def answers(requests, answer, label, coded=False):
        rows = requests.collect()
        for r in rows:
            asked[r["kind"]] = asked.get(r["kind"], 0) + len(exchange._keys_of(r["keys"], coded))
        found, sums = exchange.answers(requests, answer, label, coded)
        for r in found.collect():
            weights.extend(w for w in exchange.received(r["found"], 103, [float, float])[1])
        return found, sums

    monkeypatch.setattr("millrace.llm.katz.answers", answers)
    texts = [" ".join(f"w{i}x{j % 20}" for j in range(40)) for i in range(9)] + ["x y z x y q", "x y z x y z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    scores = score_texts(docs, trains=F.col("doc_id") < 10, order=3)
    assert scores.count() == len(texts)
    assert asked[2] > 9 * 20  # nothing is known yet when pairs are counted
    assert asked[3] < 60  # starts and ends of texts and what the held-out one holds; 200 triples before
    assert sum(w != 1 for w in weights) <= 6
