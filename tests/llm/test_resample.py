"""Importance resampling against counting with dictionaries."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm.queries import op12_importance_resampling
from millrace.llm.resample import Crc, Features, bucket_counts, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words_of(text):
    return WORD.findall((text or "").translate(UPPER))


def features_of(text, longest=3):
    words = words_of(text)
    return [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def buckets_of(text, buckets, longest=3):
    return [zlib.crc32(f.encode()) % buckets for f in features_of(text, longest)]


def expected(documents, target, buckets=10_000, least=20, percent=5, seed=42, longest=3):
    """(key, n_words, n_features, weight, score, rank) by brute force."""
    s = Counter(b for _, t in documents for b in buckets_of(t, buckets, longest))
    t = Counter(b for x in target for b in buckets_of(x, buckets, longest))
    whole_s, whole_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * whole_s / ((s[b] + 1) * whole_t))) for b in range(buckets)]
    rows = []
    for key, text in documents:
        found = buckets_of(text, buckets, longest)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((key, len(words_of(text)), len(found), weight, score))
    may = sorted((r for r in rows if r[0] is not None and r[1] >= least), key=lambda r: (-r[4], r[0]))
    drawn = may[: len(may) * percent // 100]
    return [(*r, i) for i, r in enumerate(drawn, 1)] + [(*r, None) for r in may[len(drawn) :] + [r for r in rows if r not in may]]


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_checksums_of_joined_strings():
    rnd = random.Random(0)
    parts = [rnd.randbytes(n) for n in [0, 1, 2, 7, 255, 256, 257, 511, 4096, 70_000, 1_000_003]]
    crc = np.array([zlib.crc32(p) for p in parts], np.uint32)
    sizes = np.array([len(p) for p in parts])
    for a in parts:
        found = Crc().joined(np.full(len(parts), zlib.crc32(a), np.uint32), crc, sizes)
        assert found.tolist() == [zlib.crc32(a + b) for b in parts]


def test_features_of_odd_texts():
    long = "x" * 5000
    texts = ["", "one", "One TWO\ttwo", f"a {long} b {long}é c", "été Ünï \U0001f600 4x", "a--b\x00c\x7fd", "_ _", long, "the " * 700]
    for longest in (1, 2, 3, 5):
        features = Features(Crc(), [t.encode() for t in texts], longest, 997)
        want = [buckets_of(t, 997, longest) for t in texts]
        assert features.numbers().tolist() == [len(w) for w in want]
        assert features.counts(997).tolist() == np.bincount(sum(want, []), minlength=997).tolist()
        gains = np.arange(997) ** 2 - 300_000
        assert features.weights(gains).tolist() == [sum(int(gains[b]) for b in w) for w in want]
    assert Features(Crc(), [], 3, 10).counts(10).sum() == 0


ODD = [
    (1, None), (2, ""), (3, " ,. "), (4, "word " * 30_000), (5, "one two three"), (None, "one two " * 20),
    (6, "É   x"), (7, "y" * 3000 + " one two " * 11),
]


def frame(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs.select("*", *[F.lit("x").alias(n) for n in ("bucket", "score", "rank", "row", "0", "1", "above")])


@pytest.mark.parametrize("percent", [0, 5, 60, 100])
def test_draw_is_the_same_as_by_dictionaries(spark, percent):
    rnd = random.Random(9)
    rows = ODD + [(100 + i, " ".join(rnd.choices("the of One two zwei drei x9".split(), k=rnd.randint(15, 60)))) for i in range(60)]
    target = ["one two three", None, "", "the one"]
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    found = resample(frame(spark, rows).repartition(5), goal, buckets=500, percent=percent)
    assert ordered(found.collect()) == ordered(expected(rows, target, 500, percent=percent))


def test_repeated_rows_rank_one_after_the_other(spark):
    rows = [(1, "one two " * 12)] * 40 + [(2, "two one " * 12)] * 20
    goal = spark.createDataFrame([("one two",)], "text string")
    found = resample(frame(spark, rows), goal, percent=50).collect()
    assert len(found) == 60 and sorted(r["rank"] for r in found if r["rank"]) == list(range(1, 31))
    best = max(found, key=lambda r: r["score"])["doc_id"]
    assert {r["doc_id"] for r in found if r["rank"] and r["rank"] <= 20} == {best}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "one two " * 12)], "doc_id long, text string")
    assert resample(none, some).count() == 0
    assert ordered(resample(some, none, percent=100).collect()) == ordered(expected([(1, "one two " * 12)], [], percent=100))
    assert bucket_counts(none).count() == 0


def test_query_on_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = [(r[0], *r[2:]) for r in expected(rows, target)]
    assert ordered(op12_importance_resampling(spark, sf).collect()) == ordered(want)
