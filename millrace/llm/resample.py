"""Importance resampling towards a target distribution, by hashed n-grams of words."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterable, Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.storage import written
from millrace.llm.text import bounded, texts_of
from millrace.operators.order_statistics import running_total

BUCKETS = 10_000
MAX_WORDS = 3

_BATCH_BYTES = 4 << 20
_WORD_BYTES = bytes(range(ord("0"), ord("9") + 1)) + bytes(range(ord("a"), ord("z") + 1)) + bytes(range(0x80, 0x100))
_BETWEEN = bytes(sorted(set(range(256)) - set(_WORD_BYTES)))
_SPACED = bytes.maketrans(_BETWEEN, b" " * len(_BETWEEN))
#: Words of more characters are found by a pattern instead of the automaton, whose nodes they would fill.
_LONG = 1024
_LONG_WORD = re.compile(r"[^ ]{%d,}" % (_LONG + 1))
_POLYNOMIAL = 0xEDB88320


class Crc:
    """CRC32 of byte strings put one after the other, from their CRCs and lengths.

    Appending n zero bytes is a linear map of the 32 bits, so that the CRC of `ab` is the map of
    a's CRC for the length of b, exclusive-or b's CRC. Maps are kept as four tables of 256
    entries, for every length below 256 and for every power of two from there.
    """

    def __init__(self) -> None:
        byte = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(_POLYNOMIAL), byte >> 1)
        maps = [np.concatenate([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])]
        for _ in range(256):
            maps.append(byte[maps[-1] & 255] ^ (maps[-1] >> 8))
        self._short = np.concatenate(maps[:256])
        self._powers = [maps[256]]

    @staticmethod
    def _mapped(tables: np.ndarray, at: np.ndarray | int, x: np.ndarray) -> np.ndarray:
        found = tables[at + (x & 255)]
        for k in range(1, 4):
            found ^= tables[at + 256 * k + ((x >> np.uint32(8 * k)) & 255)]
        return found

    def joined(self, a: np.ndarray, b: np.ndarray, length_of_b: np.ndarray) -> np.ndarray:
        found = self._mapped(self._short, (length_of_b & 255) << 10, a)
        rest, power = length_of_b >> 8, 0
        while rest.any():
            if power == len(self._powers):
                self._powers.append(self._mapped(self._powers[-1], 0, self._powers[-1]))
            odd = (rest & 1) > 0
            found[odd] = self._mapped(self._powers[power], 0, found[odd])
            rest, power = rest >> 1, power + 1
        return found ^ b


def _scanned(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """CRC << 32 | length of every word of all texts in order, and how many words each text has.

    The distinct words, each between two spaces, are an Aho-Corasick automaton that carries
    these numbers. A match ends at the space after a word, so there is one for each place.
    """
    spaced = [b" " + t.lower().translate(_SPACED) + b" " for t in texts]
    automaton, longest = ahocorasick.Automaton(), 0
    for word in set(b"".join(spaced).split()):
        letters = word.decode()
        longest = max(longest, len(letters))
        if len(letters) <= _LONG:
            automaton.add_word(f" {letters} ", zlib.crc32(word) << 32 | len(word))
    if len(automaton):
        automaton.make_automaton()
    found = []
    for text in map(bytes.decode, spaced):
        matches = automaton.iter(text) if len(automaton) else ()
        if longest > _LONG:
            matches, words = list(matches), (m for m in _LONG_WORD.finditer(text))
            raw = [(m.end(), m.group().encode()) for m in words]
            matches = sorted(matches + [(end, zlib.crc32(w) << 32 | len(w)) for end, w in raw])
        found.append(np.fromiter(map(itemgetter(1), matches), np.uint64))
    return np.concatenate([np.zeros(0, np.uint64), *found]), np.array([len(f) for f in found], np.int64)


class Features:
    """Buckets of all runs of 1 to `max_words` words of some texts."""

    def __init__(self, crc: Crc, texts: list[bytes], max_words: int, buckets: int) -> None:
        payload, self.sizes = _scanned(texts)
        single = (payload >> np.uint64(32)).astype(np.uint32)
        lengths = (payload & np.uint64(0xFFFFFFFF)).astype(np.int64)
        self._ends = np.cumsum(self.sizes)
        self._starts = self._ends - self.sizes
        place = np.arange(len(single)) - np.repeat(self._starts, self.sizes)
        space = np.array([zlib.crc32(b" ")], np.uint32)
        one = np.ones(1, np.int64)
        run, self.last, self.buckets = single, [], []
        for k in range(max_words):
            if k:  # a run of k words, a space, and the word after it
                run = crc.joined(crc.joined(run[:-1], space, one), single[k:], lengths[k:])
            at = np.flatnonzero(place[k:] >= k)
            self.last.append(at + k)
            self.buckets.append(run[at] % np.uint32(buckets))

    def counts(self, buckets: int) -> np.ndarray:
        return sum(np.bincount(b, minlength=buckets) for b in self.buckets)

    def numbers(self) -> np.ndarray:
        """How many features each text has."""
        return sum(np.maximum(self.sizes - k, 0) for k in range(len(self.buckets)))

    def weights(self, gains: np.ndarray) -> np.ndarray:
        """The sum of gains of each text."""
        at_word = np.zeros(len(self._ends) and int(self._ends[-1]), np.int64)
        for last, bucket in zip(self.last, self.buckets):
            at_word[last] += gains[bucket]
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(at_word)])
        return total[self._ends] - total[self._starts]


def bucket_counts(documents: DataFrame, *, text: str = "text", max_words: int = MAX_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """Rows (bucket, n) of all features of all texts, for the buckets that occur.

    Every task adds up its own texts, so that no more than `buckets` rows of it are shuffled.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc, total = Crc(), np.zeros(buckets, np.int64)
        for whole in batches:
            for batch in bounded(whole, text, _BATCH_BYTES):
                total += Features(crc, texts_of(batch.column(text)), max_words, buckets).counts(buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    counted = documents.select(text).mapInArrow(count, "bucket int, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 ln(p / q)) of every bucket, p and q its shares of target and source, each plus one.

    Both tables have a row for each bucket at most, and are summed up on the driver.
    """
    sides = []
    for counted in (source, target):
        n = np.zeros(buckets, np.int64)
        for bucket, found in counted.collect():
            n[bucket] = found
        sides.append(n)
    s, t = sides
    whole_s, whole_t = float(s.sum() + buckets), float(t.sum() + buckets)
    ratios = [float(b + 1) * whole_s / (float(a + 1) * whole_t) for a, b in zip(s.tolist(), t.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def gumbel(name: str, seed: int | str) -> int:
    """A Gumbel number in thousandths, from the first 32 bits of sha256 of `seed:name`."""
    h = int.from_bytes(hashlib.sha256(f"{seed}:{name}".encode()).digest()[:4], "big")
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(
    documents: DataFrame, gains: np.ndarray, *, key: str = "doc_id", text: str = "text", max_words: int = MAX_WORDS,
    seed: int | str = 42,
) -> DataFrame:
    """`key`, n_words, n_features, weight and score (long) of every whole text; see `resample`."""
    shared = documents.sparkSession.sparkContext.broadcast(gains)
    names = [key, "n_words", "n_features", "weight", "score"]
    schema = f"`{key}` {documents.schema[key].dataType.simpleString()}, " + ", ".join(f"`{n}` bigint" for n in names[1:])
    rows = documents.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("0"), F.col(text).alias("1"), F.col(key).alias("2"))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc = Crc()
        for whole in batches:
            for batch in bounded(whole, "1", _BATCH_BYTES):
                features = Features(crc, texts_of(batch.column(1)), max_words, len(shared.value))
                weights = features.weights(shared.value)
                noise = np.array([gumbel(k, seed) for k in batch.column(0).to_pylist()], np.int64)
                made = [features.sizes, features.numbers(), weights, weights + noise]
                yield pa.RecordBatch.from_arrays([batch.column(2), *map(pa.array, made)], names=names)

    return rows.mapInArrow(score, schema)


def resample(
    documents: DataFrame,
    target: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    max_words: int = MAX_WORDS,
    buckets: int = BUCKETS,
    least_words: int = 20,
    percent: int = 5,
    seed: int | str = 42,
) -> DataFrame:
    """Draw the documents that are most like `target`, with chance: the highest scores.

    A word is a run of 0-9, a-z (A-Z are lower-cased) and all beyond ASCII. Features are all
    runs of 1 to `max_words` words of a text, repeats included, by crc32 of their UTF-8 modulo
    `buckets`. The weight of a text is the sum of its features' gains (`bucket_gains`, counted
    over all `documents` and all `target` texts), its score the weight plus a Gumbel number, so
    that the highest scores are a draw without replacement in proportion to the likelihood
    ratio. Of the N documents with `least_words` words or more, N * `percent` // 100 are drawn.

    Returns one row for each row of `documents`: `key`, n_words, n_features, weight, score and
    rank (long; 1 is the highest score, then the lower key, then any order of equal rows; null
    where not drawn). Null and empty texts have no features and weight 0. Rows with a null key
    are scored, but neither counted in N nor drawn. Without documents nothing is drawn, without
    target texts all its buckets count as equally likely. Other columns may have any name.

    Scores are written once, by row; ranks are running counts over those narrow rows.
    """
    sides = [bucket_counts(side, text=text, max_words=max_words, buckets=buckets) for side in (documents, target)]
    gains = bucket_gains(*sides, buckets)
    found = scored(documents, gains, key=key, text=text, max_words=max_words, seed=seed)
    columns = found.columns
    rows = written(found.toDF(*map(str, range(5))).withColumn("row", F.monotonically_increasing_id()), "scores")
    may = F.col("0").isNotNull() & (F.col("1") >= least_words)
    drawn = rows.where(may).count() * percent // 100
    order = F.struct((-F.col("4")).alias("score"), F.col("0").alias("key"), "row")
    ranked = running_total(rows.where(may).select("*", order.alias("order"), F.lit(1).cast("long").alias("one")), "order", {"above": "one"})
    rank = F.when(F.col("above") < drawn, F.col("above") + 1)
    every = ranked.select(*map(str, range(5)), rank.alias("rank"))
    others = rows.where(~may).select(*map(str, range(5)), F.lit(None).cast("long").alias("rank"))
    return every.union(others).toDF(*columns, "rank")
