"""Operators on small frames: nulls, empty and long texts, ties, repeated rows, no rows, other columns."""

import random
from urllib.parse import urlsplit

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F

from millrace.llm import boosted_rules, bpe, exchange, nbsvm, substring, url_rules
from millrace.llm.components import components
from millrace.llm.decontaminate import align, contaminated
from millrace.llm.preference import preference_rows
from millrace.llm.simhash import near_duplicates
from millrace.llm.substring import lengths_to, remove_repeats
from millrace.llm.url_rules import url_verdicts

LONG = "word " * 30_000
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, LONG), (5, "one two"), (5, "one two"), (None, "one two"), (6, "É \u00a0\u2003x")]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, beside columns named like those of results."""
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    names = ["score", "kept", "row", "found", "ids", "component_id", "n_words", "label", "key"]
    return docs.select("*", *[F.lit("x").alias(n) for n in names])


# 1


def test_classifier_learns_and_scores_odd_texts(spark, odd):
    rnd = random.Random(1)
    rows = []
    for i in range(300):
        good = i % 3 > 0
        words = rnd.choices("the of and a in on to by it is".split(), k=rnd.randint(5, 60))
        rows.append((i, " ".join(w if good else w + "%%%" for w in words), int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    fits = F.col("doc_id") < 200
    model = nbsvm.fit_quality_classifier(docs.drop("quality"), docs.select("doc_id", "quality"), fits=fits)
    scored = {r["doc_id"]: r["predicted"] for r in nbsvm.quality_scores(docs, model).collect()}
    assert all(scored[i] == q for i, _, q in rows)
    assert nbsvm.quality_scores(odd, model).where("score BETWEEN 0 AND 1").count() == len(ODD)
    assert nbsvm.quality_scores(odd.limit(0), model).count() == 0
    none = nbsvm.fit_quality_classifier(docs, docs.select("doc_id", "quality").limit(0), fits=fits)
    assert {r["score"] for r in nbsvm.quality_scores(docs, none).collect()} == {0.5}


def test_dual_descent_meets_its_optimum():
    rnd = np.random.default_rng(0)
    found = [np.sort(rnd.choice(30, 6, replace=False)) for _ in range(80)]
    y = np.array([int(f[0] < 4) for f in found])
    w, bias = nbsvm.dual_descent(found, np.ones(30), y, cost=1.0, epochs=500, tolerance=1e-6)
    sign, x = np.where(y > 0, 1, -1), np.zeros((80, 31))
    for i, f in enumerate(found):
        x[i, f], x[i, 30] = 1 / np.sqrt(6), 1
    cost = 0.5 / np.where(y > 0, y.mean(), 1 - y.mean())

    def loss(v):
        return v @ v / 2 + (cost * np.maximum(0, 1 - sign * (x @ v))).sum()

    best = np.append(w, bias)
    assert all(loss(best) <= loss(best + rnd.normal(0, s, 31)) + 1e-4 for s in (1e-3, 1e-2, 0.1) for _ in range(50))


# 2


def brute_rule(rules, host, path):
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)


@pytest.mark.parametrize("max_bytes", [url_rules.MAX_RULE_BYTES, 300])
def test_urls_against_all_rules(spark, max_bytes):
    rnd = random.Random(2)
    labels, parts = ["a", "b", "com", "org", "x,y", ""], ["", "/", "/a", "/a/", "/a/b", "/b/é", "/a/b/c?q", "#f", "/A"]
    rules = {(".".join(rnd.choices(labels[:5], k=rnd.randint(1, 3))), rnd.choice(parts[:6])): rnd.choice(["allow", "block"]) for _ in range(40)}
    urls = [None, "", "no scheme/a", "://", "http://", "HTTP://A.Com/A?x://y", "x://y://z/"]
    urls += ["http://" + ".".join(rnd.choices(labels, k=rnd.randint(1, 5))) + "".join(rnd.choices(parts, k=2)) for _ in range(400)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit(1)).repartition(3)
    table = spark.createDataFrame([(*k, v) for k, v in rules.items()] + [(None, "/", "block")], "host string, path string, verdict string")
    got = {r["page_id"]: r for r in url_verdicts(pages, table, max_rule_bytes=max_bytes).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = next((k for k, c in enumerate(rest) if c in "/?#"), len(rest))
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        rule = brute_rule([(*k, v) for k, v in rules.items()], host, path)
        assert (got[i]["host"], got[i]["path"]) == (host, path)
        assert got[i]["rule"] == (rule and rule[0] + rule[1])
        assert got[i]["verdict"] == (rules[rule[:2]] if rule else "allow")


def test_urls_without_rules_or_rows(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a/b"), (1, "http://a/b")], "page_id long, url string")
    assert [r["verdict"] for r in url_verdicts(pages, none, default="block").collect()] == ["block"] * 2
    assert url_verdicts(pages.limit(0), none).count() == 0


# 3


def test_trees_are_monotonic_and_flat_arrays_agree_with_walks():
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(2000, 3))
    y = ((-x[:, 0] + 0.5 * x[:, 1] ** 2 + rnd.normal(0, 0.5, 2000)) > 0).astype(float)
    trees = boosted_rules.fit_trees(x, y, np.array([-1, 0, 0]))
    assert ((trees.scores(x) > 0.5) == y).mean() > 0.8
    for row in x[:50]:
        line = np.tile(row, (40, 1))
        line[:, 0] = np.linspace(-3, 3, 40)
        assert (np.diff(trees.margins(line)) <= 1e-12).all()
        total = trees.start
        for root in trees.roots:
            at = root
            while trees.left[at] != at:
                at = trees.left[at] + (row[trees.feature[at]] > trees.threshold[at])
            total += trees.value[at]
        assert total == pytest.approx(trees.margins(row[None])[0])
    assert boosted_rules.fit_trees(x[:0], y[:0], np.zeros(3)).scores(x[:2]).tolist() == [0.5, 0.5]


def test_rules_on_odd_texts(spark, odd):
    model = boosted_rules.fit_trees(np.zeros((0, len(boosted_rules.FEATURES))), np.zeros(0), np.zeros(13))
    rows = boosted_rules.quality_rules(odd, model, keep=("doc_id",)).collect()
    assert sorted(r["n_words"] for r in rows) == [0, 0, 0, 2, 2, 2, 2, 30_000]
    assert all(r["base_failed"] and not r["kept"] for r in rows)
    assert boosted_rules.quality_rules(odd.limit(0), model).count() == 0


# 4


def brute_repeats(texts, window):
    words = [(t or "").split() for t in texts]
    counts = {}
    for w in words:
        for i in range(len(w) - window + 1):
            counts[tuple(w[i : i + window])] = counts.get(tuple(w[i : i + window]), 0) + 1
    out = []
    for w in words:
        gone = {i + k for i in range(len(w) - window + 1) if counts[tuple(w[i : i + window])] > 1 for k in range(window)}
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("window,least,letters", [(35, 18, "abcdefghij"), (35, 5, "ab"), (7, 2, "abc"), (4, 4, "ab"), (6, 3, "a")])
def test_repeats_against_all_windows(spark, monkeypatch, window, least, letters):
    monkeypatch.setattr(exchange, "CHUNK_BYTES", 700)
    monkeypatch.setattr(exchange, "_BUCKET_BYTES", 900)
    rnd = random.Random(window)
    passage = rnd.choices(letters, k=window + 3)
    texts = [None, "", "a", " ".join(passage)]
    for _ in range(60):
        own = rnd.choices(letters, k=rnd.randint(0, 3 * window))
        cut = rnd.randint(0, window + 3)
        texts.append("  ".join(own + (passage[cut:] + passage[:cut] if rnd.random() < 0.3 else passage * (rnd.random() < 0.3))))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("spans", F.lit(1)).repartition(3)
    got = {r["doc_id"]: r for r in remove_repeats(docs, window=window, least=least).collect()}
    expected = brute_repeats(texts, window)
    assert [(got[i]["n_words"], got[i]["n_removed"], got[i]["text"]) for i in range(len(texts))] == expected
    assert all(sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] for r in got.values())


def test_chunks_are_written_and_read_a_few_at_a_time(spark, monkeypatch):
    """A file holds as many chunks as its task made, a group of its rows only a few: a task holds one group."""
    monkeypatch.setattr(exchange, "CHUNK_BYTES", 50)
    docs = spark.range(20).select("id", F.repeat(F.lit("word "), 10).alias("text")).coalesce(1)
    chunks = exchange.chunked(docs, ["id"], "text")
    files = [pq.ParquetFile(urlsplit(f).path).metadata for f in chunks.inputFiles()]
    groups = [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]
    assert sum(groups) == chunks.count() == 20 and len([m for m in files if m.num_rows]) == 1
    assert max(groups) <= exchange.CHUNKS_IN_HAND < 20


def test_repeats_in_odd_texts(spark, odd):
    rows = {(r["doc_id"], r["n_words"], r["n_removed"]) for r in remove_repeats(odd).collect()}
    assert (4, 30_000, 30_000) in rows and (1, 0, 0) in rows and (None, 2, 0) in rows
    assert remove_repeats(odd.limit(0)).count() == 0
    assert lengths_to(35, 18) == [18, 35] and lengths_to(35, 5) == [5, 9, 18, 35] and lengths_to(1, 1) == [1]
    assert substring.WINDOW == 35


# 6


def conversation(spark, rows):
    return spark.createDataFrame(rows, "pair_id long, turn int, role string, text string").withColumn("side", F.lit(1))


def test_preference_pairs(spark):
    chosen = conversation(spark, [
        (1, 1, "assistant", "hi é"), (1, 0, "user", "hello"), (1, 2, "user", "go"), (1, 3, "assistant", "ok"),
        (2, 0, "user", "same"), (3, 0, "user", "alone"), (None, 0, "user", "x"), (4, 0, None, None), (5, 0, "user", "a"), (5, 0, "user", "a"),
    ])
    rejected = conversation(spark, [
        (1, 0, "user", "hello"), (1, 1, "assistant", "hi é"), (1, 2, "user", "go"), (1, 3, "assistant", "no no"), (1, 4, "user", "why"),
        (2, 0, "user", "same"), (4, 0, "", "b"), (5, 0, "user", "a"),
    ])
    got = {r["pair_id"]: r for r in preference_rows(chosen, rejected).collect()}
    assert set(got) == {1, 2, 4, 5}
    one = got[1]
    assert one["prompt_turns"] == 3
    assert one["prompt"] == "<|user|>\nhello<|end|>\n<|assistant|>\nhi é<|end|>\n<|user|>\ngo<|end|>\n"
    assert one["chosen"] == "<|assistant|>\nok<|end|>\n"
    assert [one["chosen"][s["start"] : s["end"]] for s in one["chosen_mask"]] == ["ok<|end|>"]
    assert [one["rejected"][s["start"] : s["end"]] for s in one["rejected_mask"]] == ["no no<|end|>"]
    assert (got[2]["chosen"], got[2]["rejected"], got[2]["chosen_mask"]) == ("", "", [])
    assert (got[4]["prompt"], got[4]["chosen"]) == ("", "<||>\n<|end|>\n")
    assert got[5]["prompt_turns"] == 1 and got[5]["rejected"] == "" and got[5]["chosen"] == "<|user|>\na<|end|>\n"
    assert preference_rows(chosen.limit(0), rejected).count() == 0


# 7


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_tokenizer_on_odd_texts(ranks):
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(7)
    signs = list("abcE \n\t  ''streve.,!?019éñß你😀\u00a0\u3000\x1c\u0085\u200b")
    texts = ["".join(rnd.choices(signs, k=rnd.randint(0, 40))) for _ in range(500)]
    texts += ["", " ", "  ", " a", "a ", "a  b", "a \nb", "ab " * 3000, "abc" * 400, "\n \n"]
    tokenizer = bpe.Tokenizer(ranks, public_tokenizers.PATTERN)
    for _ in range(2):
        ids = tokenizer.encode(texts)
        assert [x.tolist() for x in ids] == [whole.encode_ordinary(t) for t in texts]
    assert tokenizer.decode(ids) == [t.encode() for t in texts]
    assert tokenizer.encode([]) == [] and tokenizer.decode([]) == []


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "etaoin", "ab", "a", "éü漢字", "=-"])
def test_long_words(ranks, letters):
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(8)
    texts = ["".join(rnd.choices(letters, k=n)) for n in [65, 66, 300, 1000, 4000, *rnd.choices(range(65, 400), k=30)]]
    tokenizer = bpe.Tokenizer(ranks, public_tokenizers.PATTERN)
    assert [x.tolist() for x in tokenizer.encode(texts)] == [whole.encode_ordinary(t) for t in texts]


def contracted(word, ranks):
    """One leftmost pair of least rank at a time."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while True:
        pairs = [(ranks.get(a + b, len(ranks)), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        rank, i = min(pairs, default=(len(ranks), 0))
        if rank == len(ranks):
            return [ranks[p] for p in parts]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize("seed", range(6))
def test_long_words_by_ranks_in_any_order(seed):
    rnd = random.Random(seed)
    tokens = {"".join(rnd.choices("abc", k=rnd.choice([2, 2, 3, 3, 4, 5, 8]))).encode() for _ in range(40)}
    order = sorted(tokens)
    rnd.shuffle(order)
    ranks = {t: i for i, t in enumerate([*(bytes([b]) for b in range(256)), *order])}
    tokenizer = bpe.Tokenizer(ranks, r"\w+")
    for _ in range(8):
        texts = ["".join(rnd.choices("abcd", (9, 9, 9, 1), k=rnd.randint(65, 200))) for _ in range(10)]
        assert [x.tolist() for x in tokenizer.encode(texts)] == [contracted(t.encode(), ranks) for t in texts]


def test_decoding_opens_no_database(ranks, monkeypatch):
    texts = ["", "a tale of thé 漢字 😀", "x" * 5000, " \n "]
    ids = bpe.Tokenizer(ranks, public_tokenizers.PATTERN).encode(texts)
    monkeypatch.setattr(bpe.duckdb, "connect", lambda **_: pytest.fail("a database"))
    monkeypatch.setattr(bpe, "_PART_TOKENS", 3)
    tokenizer = bpe.Tokenizer(ranks, "")
    assert tokenizer.decode(ids) == [t.encode() for t in texts]
    strange = [np.array([-1, *x.tolist(), 1 << 30], np.int32) for x in ids]
    assert tokenizer.decode(strange) == [t.encode() for t in texts]


def test_tokenizer_forgets_pieces_too(ranks, monkeypatch):
    monkeypatch.setattr(bpe, "_KNOWN_WORDS", 1000)
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    tokenizer, most = bpe.Tokenizer(ranks, public_tokenizers.PATTERN), 0
    for start in range(0, 3000, 300):
        texts = [f"some-{i} more-{i}" for i in range(start, start + 300)]
        assert [x.tolist() for x in tokenizer.encode(texts)] == [whole.encode_ordinary(t) for t in texts]
        most = max(most, len(tokenizer._words) + len(tokenizer._pieces))
    assert most < 3000


def test_encode_and_decode_keep_other_columns(spark, odd, ranks):
    encoded = bpe.encode(odd, ranks, public_tokenizers.PATTERN)
    rows = bpe.decode(encoded, ranks).collect()
    assert len(rows) == len(ODD) and all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in rows)
    assert {r["row"] for r in rows} == {"x"}
    assert bpe.encode(odd.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


# 8


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_near_duplicates_at_distances(spark, distance, monkeypatch):
    from millrace.llm import simhash

    rnd = random.Random(distance)
    centres = [rnd.getrandbits(64) for _ in range(4)]
    prints = [rnd.choice(centres) ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 3))) for _ in range(150)]
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    points = spark.createDataFrame(rows, "node long, fingerprint long").groupBy("fingerprint").agg(F.min("node").alias("node"))
    own = {r["fingerprint"]: r["node"] for r in points.collect()}
    reached = {r["node"]: r["component"] for r in components(simhash.ball_links(points, distance)).collect()}
    label = dict.fromkeys(range(150))
    for i in range(150):
        label[i] = own[rows[i][1]]
    changed = True
    while changed:
        changed = False
        for i in range(150):
            for j in range(150):
                if label[i] < label[j] and (prints[i] ^ prints[j]).bit_count() <= distance:
                    label[j], changed = label[i], True
    assert all(reached.get(own[rows[i][1]], own[rows[i][1]]) == label[i] for i in range(150))


def test_near_duplicates_of_odd_texts(spark, odd):
    got = sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in near_duplicates(odd).collect())
    assert len(got) == len(ODD) - 1
    assert [c for _, _, c in got] == [1, 1, 1, 4, 5, 5, 6] and got[0][1] == "0" * 16
    assert near_duplicates(odd.limit(0)).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 300)]
    star = [(7, i) for i in range(1000, 1500)] + [(3, 1400), (None, 3), (5, 5)]
    rnd = random.Random(0)
    rnd.shuffle(path)
    edges = spark.createDataFrame([(b, a) if rnd.random() < 0.5 else (a, b) for a, b in path + star], "u long, v long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**dict.fromkeys(range(100, 301), 100), **dict.fromkeys([3, 7, *range(1000, 1500)], 3)}


# 9


def brute_align(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if x == y else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return int(h.max())


def test_alignment_against_the_whole_matrix():
    rnd = np.random.default_rng(9)
    for _ in range(60):
        a, b = rnd.integers(0, 4, rnd.integers(1, 20)), rnd.integers(0, 4, rnd.integers(0, 40))
        assert align(a, b)[0] == brute_align(a, b)


@pytest.mark.parametrize("max_bytes", [1 << 20, 400])
def test_contaminated_documents(spark, max_bytes):
    rnd = random.Random(9)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 7))) for _ in range(3000)]
    items = [" ".join(rnd.choices(words, k=rnd.randint(15, 40))) for _ in range(12)]
    texts = [" ".join(rnd.choices(words, k=rnd.randint(0, 300))) for _ in range(200)] + [None, ""]
    planted = {}
    for i in range(0, 200, 5):
        item = rnd.randrange(12)
        copy = items[item].split()
        for k in range(len(copy)):
            if i % 2 and rnd.random() < 0.15:
                copy[k] = rnd.choice(words)
        at = rnd.randint(0, len(texts[i]))
        texts[i] = texts[i][:at] + "\n" + " ".join(copy).upper() + ".\n" + texts[i][at:]
        planted[i] = item
    docs = spark.createDataFrame([*enumerate(texts), (0, texts[0]), (None, items[0])], "doc_id long, text string").withColumn("item_id", F.lit("x"))
    tests = spark.createDataFrame([*enumerate(items), (50, None), (51, "too short"), (3, items[3])], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in contaminated(docs, tests, max_item_bytes=max_bytes).collect()}
    assert set(got) == set(planted.items())
    assert all(r["score"] == 1 for (k, _), r in got.items() if k % 2 == 0)
    assert contaminated(docs, tests.limit(0)).count() == 0 and contaminated(docs.limit(0), tests).count() == 0


@pytest.mark.parametrize("size", [1, 400])
def test_edited_copies_against_alignment_over_whole_texts(spark, size):
    rnd = random.Random(size)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 7))) for _ in range(2000)]
    items = [rnd.choices(words, k=60) for _ in range(8)]

    def edited(kind, item):
        if kind == "third":
            return [rnd.choice(words) if i % 3 == 2 else w for i, w in enumerate(item)]
        if kind == "head":
            return item[:40]
        if kind == "late":  # and the opening again further on
            return [rnd.choice(words) if i < 39 and i % 3 == 2 else w for i, w in enumerate(item)] + item[:3]
        return [rnd.choice(words) if rnd.random() < 0.25 else w for w in item]

    texts = []
    for i in range(40):
        item = items[rnd.randrange(8)]
        copy = edited(("third", "head", "late", "any")[i % 4], item)
        texts.append(" ".join(rnd.choices(words, k=rnd.randint(0, 100)) + copy + rnd.choices(words, k=rnd.randint(0, 100))))
    texts += [" ".join(rnd.choices(words, k=150)) for _ in range(size - 1)]
    number = {w: i for i, w in enumerate(words, 1)}
    coded = [np.array([number[w] for w in t.split()]) for t in texts]
    expected = {}
    for k, item in enumerate(items):
        for i, text in enumerate(coded):
            score = align(np.array([number[w] for w in item]), text)[0] / 120
            if score >= 0.5:
                expected[i, k] = score
    tests = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    parts = [docs] if size > 1 else [docs.where(F.col("doc_id") == i) for i in range(0, 12)]
    got = {(r["doc_id"], r["item_id"]): r["score"] for part in parts for r in contaminated(part, tests).collect()}
    if size == 1:  # corpora of a single document
        expected = {(i, k): s for (i, k), s in expected.items() if i < 12}
    assert set(got) <= set(expected) and len(got) >= 0.95 * len(expected)
    assert sum(abs(got[p] - expected[p]) < 1e-9 for p in got) >= 0.95 * len(got)


def test_short_items_are_found_by_exact_copies(spark):
    texts = ["x y Is this, it? z is this it", "this is it", "is this", "one two three four five six seven", "one two three four five six", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = [(1, "Is this it"), (2, "one two three four five six seven"), (3, "z"), (4, "..."), (5, "is this it")]
    got = contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"], r["score"], r["start"], r["end"]) for r in got) == [
        (0, 1, 1.0, 2, 5), (0, 3, 1.0, 5, 6), (0, 5, 1.0, 2, 5), (3, 2, 1.0, 0, 7),
    ]
