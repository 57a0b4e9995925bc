"""The registered queries: SQL where there is any, and what their contracts say of whole tables."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from compare import connect, differences
from pyspark.sql import functions as F

from millrace.llm import ORACLES, QUERIES, bpe, katz, labelled

# All pairs of windows are counted in DuckDB: on the smallest tables only.
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, ORACLES[name]) is None


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def remainder(key, modulus):
    return zlib.crc32(str(key).encode()) % modulus


def test_quality_classifier(spark, documents):
    rows = QUERIES["op1_quality_classifier"](spark, SMALL).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    assert {r["doc_id"] for r in rows} == set(documents) and len(rows) == len(documents)
    for r in rows:
        assert r["held_out"] == (remainder(r["doc_id"], 4) == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([p == q for p, q in held]) >= 0.8


def test_quality_rules(spark, documents):
    for r in QUERIES["op3_quality_rules"](spark, SMALL).collect():
        text = documents[r["doc_id"]]
        words = text.encode().split()
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
        lines = [x for x in text.split("\n") if x.encode().split()]
        expected = (
            len(words),
            sum(len(w.decode()) for w in words),
            sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)),
            len(covered),
        )
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expected
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_bpe(spark, documents):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = QUERIES["op7_byte_level_bpe"](spark, SMALL).collect()
    assert len(rows) == len(documents)
    for r in rows:
        ids = whole.encode_ordinary(documents[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(documents[r["doc_id"]].encode()).hexdigest()


def test_simhash(spark, documents):
    def fingerprint(text):
        words = text.encode().lower().split()
        grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = {k: fingerprint(t) for k, t in documents.items()}
    component = {k: k for k in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if component[b] > component[a] and (prints[a] ^ prints[b]).bit_count() <= 2:
                    component[b], changed = component[a], True
    rows = QUERIES["op8_simhash_near_dedup"](spark, SMALL).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {
        k: (format(p, "016x"), component[k]) for k, p in prints.items()
    }


def test_decontamination(spark, documents):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in QUERIES["op9_decontamination"](spark, SMALL).collect()}
    planted = {(k, i) for k, t in documents.items() for i, x in items.items() if x in t}
    assert planted <= set(found) and all(found[p] == 1 for p in planted)


def test_katz_columns(spark, documents):
    rows = QUERIES["op10_katz_scores"](spark, SMALL).collect()
    tokens = {k: [*t.encode().lower().split(), b"\n"] for k, t in documents.items()}
    counts = {}
    for k, ts in tokens.items():
        if remainder(k, 10):
            for t in ts:
                counts[t] = counts.get(t, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        ts = tokens[r["doc_id"]]
        base = sum(np.log10((counts.get(t, 0) + 0.1) / (n + 0.1 * (v + 1))) for t in ts)
        assert (r["n_tokens"], r["train_tokens"]) == (len(ts), n)
        assert r["n_known"] == sum(t in counts for t in ts)
        assert r["held_out"] == (remainder(r["doc_id"], 10) == 0)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0


def test_katz_order_is_three(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    trains = labelled.remainder(F.col("doc_id"), 10) != 0
    scores = {
        order: {r["doc_id"]: r["score"] for r in katz.score_texts(docs, trains=trains, order=order).collect()} for order in (2, 3)
    }
    got = {r["doc_id"]: r["score"] for r in QUERIES["op10_katz_scores"](spark, SMALL).collect()}
    assert got == pytest.approx(scores[3]) and got != pytest.approx(scores[2])


def test_line_dedup(spark, documents):
    rows = QUERIES["op5_line_dedup"](spark, SMALL).collect()
    assert {r["doc_id"]: r["n_lines"] for r in rows} == {k: t.count("\n") + 1 for k, t in documents.items()}
