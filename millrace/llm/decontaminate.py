"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.storage import measured
from millrace.llm.text import bounded, paired, texts_of

#: Bytes of test items that one pass over the documents takes along to every task.
MAX_ITEM_BYTES = 8 << 20
_BATCH_BYTES = 4 << 20
#: A seed is three words of an item, side by side or with any one word before the last, so that
#: copies in which every third word is another still hold seeds.
SHAPES = ((0, 1, 2), (0, 1, 3))
#: A seed is rare if independent words would form it at fewer than this share of all places, or
#: fewer than once in all documents.
RARE = 1e-8
#: The rarest seeds of an item are taken in any case, up to this number.
LEAST_SEEDS = 8
#: Shorter items are no passages: they are found by all of their words, and only as exact copies.
LEAST_WORDS = 8
MATCH, MISMATCH, GAP = 2, -1, -1

_PLAIN = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def plain_words(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters, digits and characters beyond ASCII."""
    return text.decode().lower().encode().translate(_PLAIN).split()


@dataclass
class Items:
    """A block of test items: words by number, and seeds by hash with the places they stand at.

    `short` has the items below `LEAST_WORDS`, by their number of words and the hash of all of them.
    """

    keys: list
    words: list[np.ndarray]
    vocabulary: dict[bytes, int]
    hashes: np.ndarray
    seeds: np.ndarray
    starts: np.ndarray
    owners: np.ndarray
    places: np.ndarray
    short: dict[int, dict[int, list[int]]]

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """0 for words that no item has."""
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int32, len(words))

    def hits(self, numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Item, place in the item and place in the text of every seed in a text."""
        if not len(self.seeds):
            return
        hashes = self.hashes[numbers]
        for shape in SHAPES:
            spots = np.flatnonzero(_all_known(numbers, shape))
            found = _grams(hashes, spots, shape)
            at = np.minimum(np.searchsorted(self.seeds, found), len(self.seeds) - 1)
            same = self.seeds[at] == found
            for spot, seed in zip(spots[same].tolist(), at[same].tolist()):
                for k in range(self.starts[seed], self.starts[seed + 1]):
                    yield int(self.owners[k]), int(self.places[k]), spot

    def copies(self, numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Short item, first and last place of its first exact copy in a text."""
        for length, items in self.short.items():
            spots = np.flatnonzero(_all_known(numbers, range(length)))
            grams, first = np.unique(_grams(self.hashes[numbers], spots, range(length)), return_index=True)
            for gram, spot in zip(grams.tolist(), spots[first].tolist()):
                for item in items.get(gram, ()):
                    yield item, spot, spot + length


def _all_known(numbers: np.ndarray, shape: Sequence[int]) -> np.ndarray:
    known = numbers > 0
    n = max(len(known) - shape[-1], 0)
    both = np.ones(n, bool)
    for i in shape:
        both &= known[i : i + n]
    return both


def _grams(h: np.ndarray, spots: np.ndarray, shape: Sequence[int]) -> np.ndarray:
    """Hashes of the words at `shape` after each spot; other shapes of the same words have others."""
    found = h[spots]
    for before, i in zip(shape, shape[1:]):
        found = paired(found + np.uint64(i - before - 1), h[spots + i])
    return found


def prepare(rows: list[tuple], counts: dict[bytes, int], total: int) -> Items:
    """Items with the seeds that are rare by the counts of their words in all documents."""
    keys = [k for k, _ in rows]
    vocabulary: dict[bytes, int] = {}
    words = []
    for _, text in rows:
        words.append(np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in text], np.int32))
    names = [b"", *vocabulary]
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in names], np.uint64)
    share = np.array([(counts.get(w, 0) + 1) / (total + 1) for w in names])
    entries = []
    short: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
    for item, at in enumerate(words):
        if len(at) < LEAST_WORDS:
            if len(at):
                short[len(at)][int(_grams(hashes[at], np.zeros(1, np.intp), range(len(at)))[0])].append(item)
            continue
        for shape in SHAPES:
            spots = np.arange(len(at) - shape[-1])
            chance = np.prod([share[at[spots + i]] for i in shape], axis=0)
            rank = np.argsort(np.argsort(chance, kind="stable"), kind="stable")
            chosen = spots[(chance <= max(RARE, 1 / (total + 1))) | (rank < LEAST_SEEDS)]
            entries += zip(_grams(hashes[at], chosen, shape).tolist(), repeat(item), chosen.tolist())
    entries.sort()
    seeds, starts = np.unique(np.array([e[0] for e in entries], np.uint64), return_index=True)
    owners, places = (np.array([e[i] for e in entries], np.int32) for i in (1, 2))
    exact = {n: dict(items) for n, items in short.items()}
    return Items(keys, words, vocabulary, hashes, seeds, np.append(starts, len(entries)), owners, places, exact)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """The best local alignment's score, and the place in the passage after its last word.

    Row by row over the item's words; a run of gaps in the passage is a running maximum.
    """
    n = len(passage)
    steps = np.arange(n + 1) * -GAP
    above = np.zeros(n + 1, np.int64)
    best, end = 0, 0
    for word in item:
        row = np.zeros(n + 1, np.int64)
        row[1:] = above[:-1] + np.where(passage == word, MATCH, MISMATCH)
        row = np.maximum(np.maximum(row, above + GAP), 0)
        row = np.maximum.accumulate(row + steps) - steps
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
        above = row
    return best, end


def _passages(items: Items, numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Item, first and last place of the stretches around seeds in which a copy would lie."""
    around = defaultdict(set)
    for item, place, spot in items.hits(numbers):
        slack = len(items.words[item]) // 2 + SHAPES[0][-1] + 1
        start = max(spot - place - slack, 0)
        around[item].add((start, min(spot - place + len(items.words[item]) + slack, len(numbers))))
    for item, stretches in around.items():
        joined: list[list[int]] = []
        for start, end in sorted(stretches):
            if joined and start <= joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], end)
            else:
                joined.append([start, end])
        for start, end in joined:
            yield item, start, end
    yield from items.copies(numbers)


def contaminated(
    documents: DataFrame,
    items: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    threshold: float = 0.5,
    max_item_bytes: int = MAX_ITEM_BYTES,
) -> DataFrame:
    """Pairs of a document and a test item of which the document holds a copy.

    Words are compared lower-cased and without punctuation. Every seed, three words of an item
    that are rare together, side by side or with a gap, joins the documents' passages that hold it; a passage is aligned
    with the item (+2 for equal words, -1 for different ones and for gaps), and the pair is kept
    if the best local alignment reaches `threshold` of the score of an exact copy. Whether a
    seed is rare depends on the counts of its single words in all documents, not on how often
    the seed itself is found, so that items with many leaked copies keep their seeds.

    Returns `key`, `item_key`, score (1 for an exact copy), start and end of the best alignment
    (places among the document's words so compared), one row for each pair. Null texts are empty. Items of fewer
    than eight words are matched by exact copies only, whatever `threshold` is, and those without
    a word never; rows with a null key are left out, repeated rows count
    once, and other columns may have any name.

    The items go to the tasks in blocks of at most `max_item_bytes`, with one pass over the
    documents for each; documents are not shuffled, only their passages with a seed are.
    """
    spark = documents.sparkSession
    documents = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).dropna(subset=["key"])
    items = items.select(F.col(item_key).alias("item"), F.col(item_text).alias("text")).dropna().distinct()
    key_kind, item_kind = (f.schema[0].dataType.simpleString() for f in (documents, items))
    found = spark.createDataFrame([], f"key {key_kind}, item {item_kind}, score double, start bigint, `end` bigint")
    rows, size = measured(items)
    blocks = -(-size // max_item_bytes)
    for block in range(blocks if rows else 0):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        texts = [(r["item"], plain_words(r["text"].encode())) for r in part.orderBy("item", "text").collect()]
        counts = _counts(documents, {w for _, t in texts for w in t})
        ready = prepare(texts, counts, counts.pop(b"", 0))
        passages = documents.mapInArrow(
            _searching(spark.sparkContext.broadcast(vars(ready))),
            f"key {key_kind}, number int, item array<int>, start bigint, passage array<int>",
        )
        scores = passages.repartition(F.xxhash64("key", "number", "start")).mapInArrow(
            _aligning(threshold), f"key {key_kind}, number int, score double, start bigint, `end` bigint"
        )
        names = spark.createDataFrame(list(enumerate(ready.keys)), f"number int, item {item_kind}")
        found = found.unionByName(scores.join(F.broadcast(names), "number").drop("number"))
    order = F.struct("score", (-F.col("start")).alias("first"), (-F.col("end")).alias("last"))
    best = found.groupBy("key", "item").agg(F.max(order).alias("b"))
    return best.select(
        F.col("key").alias(key),
        F.col("item").alias(item_key),
        "b.score",
        (-F.col("b.first")).alias("start"),
        (-F.col("b.last")).alias("end"),
    )


def _counts(documents: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """How often the words of a block of items stand in all documents; all words under b""."""
    shared = documents.sparkSession.sparkContext.broadcast(sorted(vocabulary))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {w: i for i, w in enumerate(shared.value, 1)}
        sums, total = np.zeros(len(number) + 1, np.int64), 0
        for batch in (part for whole in batches for part in bounded(whole, "text", _BATCH_BYTES)):
            for t in texts_of(batch.column("text")):
                words = plain_words(t)
                sums += np.bincount(
                    np.fromiter(map(number.get, words, repeat(0)), np.int32, len(words)), minlength=len(sums)
                )
                total += len(words)
        sums[0] = total
        yield pa.RecordBatch.from_arrays(
            [pa.array([b"", *number], pa.binary()), pa.array(sums)], names=["word", "n"]
        )

    made = documents.mapInArrow(count, "word binary, n bigint").where("n > 0")
    return {bytes(r["word"]): r["n"] for r in made.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def _searching(shared):
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(**shared.value)
        for batch in (part for whole in batches for part in bounded(whole, "text", _BATCH_BYTES)):
            rows = []
            for i, t in enumerate(texts_of(batch.column("text"))):
                numbers = items.numbers(plain_words(t))
                for item, start, end in _passages(items, numbers):
                    rows.append((i, item, items.words[item], start, numbers[start:end]))
            if rows:
                at, number, words, start, passage = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").take(pa.array(at)),
                        pa.array(number, pa.int32()),
                        pa.array(words, pa.list_(pa.int32())),
                        pa.array(start, pa.int64()),
                        pa.array(passage, pa.list_(pa.int32())),
                    ],
                    names=["key", "number", "item", "start", "passage"],
                )

    return search


def _aligning(threshold: float):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, scores, starts, ends = [], [], [], []
            for i in range(batch.num_rows):
                item, passage = (np.asarray(batch.column(c)[i].values) for c in ("item", "passage"))
                best, end = align(item, passage)
                if best < threshold * MATCH * len(item):
                    continue
                _, back = align(item[::-1], passage[:end][::-1])
                first = batch.column("start")[i].as_py()
                kept.append(i)
                scores.append(best / (MATCH * len(item)))
                starts.append(first + end - back)
                ends.append(first + end)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(pa.array(kept, pa.int64())),
                    batch.column("number").take(pa.array(kept, pa.int64())),
                    pa.array(scores, pa.float64()),
                    pa.array(starts, pa.int64()),
                    pa.array(ends, pa.int64()),
                ],
                names=["key", "number", "score", "start", "end"],
            )

    return score
