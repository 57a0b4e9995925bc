"""Removal of word sequences that occur more than once, by windows of doubling length."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.exchange import REQUEST, answers, asked, batch_of, bucket_count, chunked, joined, received
from millrace.llm.storage import written
from millrace.llm.text import Words, mixed, paired

WINDOW = 35
_SALT = np.uint64(0x5BD1E9955BD1E995)


def lengths_to(window: int, least: int) -> list[int]:
    """`window`, half of it (rounded up), and so on while it is `least` at least; ascending."""
    found = [window]
    while (found[-1] + 1) // 2 >= least and found[-1] > 1:
        found.append((found[-1] + 1) // 2)
    return found[::-1]


class _Chunk:
    """The words of a chunk one after the other, and the hashes of their windows."""

    def __init__(self, texts: list[bytes]) -> None:
        self.words = [t.split() for t in texts]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(self.sizes)
        numbers = Words()
        parts = [numbers.numbers(w) for w in self.words]
        self._single = numbers.hashes()[np.concatenate([np.zeros(0, np.int32), *parts])]

    def hashes(self, lengths: list[int]) -> dict[int, np.ndarray]:
        """The hash of the window of each length that starts at each position.

        A window is the pair of its first and last part, each half as long or, where that is
        no power of two, overlapping. Windows beyond the last word are not there.
        """
        n, power, h, found = len(self._single), 1, self._single, {}
        for length in sorted(lengths):
            while power * 2 <= length:
                h = paired(h[:-power], h[power:]) if len(h) > power else h[:0]
                power *= 2
            rest = length - power
            whole = n - length + 1
            found[length] = paired(h[: max(whole, 0)], h[rest : rest + max(whole, 0)]) if rest else h
        return found

    def starts(self, window: int) -> np.ndarray:
        """Positions at which a window of one document starts."""
        ok = np.zeros(len(self._single), bool)
        for end, n in zip(self.ends, self.sizes):
            if n >= window:
                ok[end - n : end - window + 1] = True
        return np.flatnonzero(ok)


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """For each position the leftmost place of the least value among the next `width`."""
    at, power = np.arange(len(h)), 1

    def lower(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(h[b] < h[a], b, a)

    while power * 2 <= width:
        at = lower(at[:-power], at[power:])
        power *= 2
    rest = width - power
    return lower(at[: len(at) - rest], at[rest:]) if rest else at


def _questions(h: dict[int, np.ndarray], alive: np.ndarray, length: int, window: int):
    """Sorted keys, how often each stands in the chunk, and the key's number for each window.

    A shorter length asks about one part of every window that is still alive: the one of the
    least hash, which depends on the words of the window alone. Windows of equal words ask about
    equal parts at different places, so a part that occurs once rules its windows out. Only
    about one part in (window - length) / 2 positions is asked about.
    """
    if length < window:
        spot = _least(h[length], window - length + 1)[alive]
        places, back = np.unique(spot, return_inverse=True)
    else:
        places, back = alive, np.arange(len(alive))
    keys, at, counts = np.unique(mixed(h[length][places] ^ _SALT), return_inverse=True, return_counts=True)
    return keys, counts.astype(np.float64), at[back]


def _alive(chunk: _Chunk, h: dict[int, np.ndarray], lengths: list[int], window: int, found: list[dict]) -> np.ndarray:
    """Starts of windows whose parts have all been found twice or more at `lengths`."""
    alive = chunk.starts(window)
    for level, length in enumerate(lengths):
        if not len(alive):
            break
        keys, _, at = _questions(h, alive, length, window)
        (repeated,) = received(found, level, [np.uint8])
        alive = alive[repeated[at] > 0]
    return alive


def _repeated(kind: int, inverse: np.ndarray, sums: np.ndarray, first: np.ndarray, own: np.ndarray):
    twice = sums[0] >= 2
    return [twice[inverse].astype(np.uint8)], [float(twice.sum())]


def remove_repeats(
    documents: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = WINDOW, least: int = 18
) -> DataFrame:
    """Every document without the words that a repeated window covers.

    A window is `window` consecutive words of one document; it is repeated if its word sequence
    also starts anywhere else, in the same document or another. All windows are judged on the
    input, so of a repeated passage no occurrence stays. Returns `key`, n_words, n_removed
    (long), text (the kept words, joined by one space) and spans, an array of (start, end) of
    the removed words. Null, empty and short texts lose nothing; repeated rows are documents of
    their own, so that they remove each other's windows; other columns may have any name.

    Lengths double up to `window`, from the first that is `least` or more: windows go on to the
    next length only if a part of the length before is repeated, and the search ends with the
    length at which none is left. Hashes have 64 bits: among n windows some n^2 / 2^65 different
    ones are expected to be taken for equal.
    """
    lengths = lengths_to(window, least)
    chunks = chunked(documents, [key], text)
    buckets = bucket_count(chunks)
    found: list[DataFrame] = []
    for level, length in enumerate(lengths):
        ask = _asking(lengths[:level], length, level, window, buckets)
        requests = joined(chunks, found).select("chunk", "texts", "found").mapInArrow(ask, REQUEST)
        reply, counted = answers(requests, _repeated, "repeated")
        found.append(reply)
        if not counted.get(level, [0.0])[0]:
            break
    kind = documents.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_words bigint, n_removed bigint, text string, spans array<struct<start:int,end:int>>"
    work = joined(chunks, found).select(key, "texts", "found")
    return written(work.mapInArrow(_removing(lengths[: len(found)], window, key), schema), "kept", 1)


def _asking(done: list[int], length: int, level: int, window: int, buckets: int):
    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row["texts"])
                h = chunk.hashes([*done, length])
                alive = _alive(chunk, h, done, window, row["found"])
                if not len(alive):
                    continue
                keys, counts, _ = _questions(h, alive, length, window)
                rows = asked(level, row["chunk"], keys, [counts], buckets)
                yield batch_of(list(rows), REQUEST)

    return ask


def _removing(lengths: list[int], window: int, key: str):
    def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = _Chunk(batch.column("texts")[i].as_py())
                alive = _alive(chunk, chunk.hashes(lengths), lengths, window, batch.column("found")[i].as_py())
                step = np.zeros(len(chunk._single) + 1, np.int64)
                np.add.at(step, alive, 1)
                np.add.at(step, alive + window, -1)
                covered = np.cumsum(step[:-1]) > 0
                kept, spans, removed = [], [], []
                for words, end, n in zip(chunk.words, chunk.ends, chunk.sizes):
                    gone = covered[end - n : end]
                    removed.append(int(gone.sum()))
                    if removed[-1]:
                        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]))).reshape(-1, 2)
                        spans.append([{"start": a, "end": b} for a, b in edges.tolist()])
                        words = [words[k] for k in np.flatnonzero(~gone)]
                    else:
                        spans.append([])
                    kept.append(b" ".join(words).decode())
                arrays = [batch.column(key)[i].values, pa.array(chunk.sizes), pa.array(removed, pa.int64())]
                arrays.append(pa.array(kept, pa.string()))
                arrays.append(pa.array(spans, pa.list_(pa.struct({"start": pa.int32(), "end": pa.int32()}))))
                yield pa.RecordBatch.from_arrays(arrays, names=[key, "n_words", "n_removed", "text", "spans"])

    return remove
