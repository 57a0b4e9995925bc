"""Words of texts, inside tasks.

A word is a run of bytes other than space and U+0009 to U+000D, which is what `bytes.split`
separates; in UTF-8 no other character holds these bytes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash


def texts_of(column: pa.Array) -> list[bytes]:
    """A text column as UTF-8; null is the empty text."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


class Words:
    """Small numbers for the words of one batch, and their 64-bit hashes."""

    def __init__(self) -> None:
        self._numbers: dict[bytes, int] = defaultdict(count().__next__)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self._numbers.__getitem__, words), np.int32, len(words))

    def hashes(self) -> np.ndarray:
        """By number."""
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self._numbers), np.uint64, len(self._numbers))


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values spread over all bits (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of ordered pairs of hashes."""
    return mixed(a * np.uint64(0x9E3779B97F4A7C15) + mixed(b))


def bounded(batch: pa.RecordBatch, text: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts hold `max_bytes` at most, or one row."""
    start, held = 0, 0
    for i, n in enumerate(pc.binary_length(batch.column(text).cast(pa.binary())).fill_null(0).to_pylist()):
        if held + n > max_bytes and i > start:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)
