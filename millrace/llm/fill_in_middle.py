"""Fill-in-middle: blocks of a text change places inside its own buffer, and back again."""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import bounded, texts_of

#: A unit is a line with the line feed that ends it.
LINES = r"[^\n]*\n|[^\n]+"
PLAIN, PSM, SPM = "plain", "psm", "spm"

_BATCH_BYTES = 4 << 20
_PIECE = 1 << 16


class Sentinels(NamedTuple):
    """The marks before prefix, suffix and middle."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def checked(self) -> tuple[bytes, bytes, bytes]:
        """The marks in UTF-8, if a text without them cannot make one up together with another.

        That would take a mark inside another, or one that ends as one begins.
        """
        marks = tuple(m.encode() for m in self)
        for i, a in enumerate(marks):
            for j, b in enumerate(marks):
                ends_alike = any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b))))
                if not a or ends_alike or (i != j and a in b):
                    raise ValueError(f"sentinels that cannot be told apart: {self}")
        return marks


def reverse(buffer: bytearray, start: int, stop: int) -> None:
    """Reverse a block in place, with room for a piece of fixed size beside it."""
    held = np.frombuffer(buffer, np.uint8)
    while stop - start > 1:
        n = min((stop - start) // 2, _PIECE)
        head = held[start : start + n].copy()
        held[start : start + n] = held[stop - n : stop][::-1]
        held[stop - n : stop] = head[::-1]
        start, stop = start + n, stop - n


def exchange(buffer: bytearray, start: int, middle: int, stop: int) -> None:
    """Let two neighbouring blocks change places: reverse each of them, then both together."""
    reverse(buffer, start, middle)
    reverse(buffer, middle, stop)
    reverse(buffer, start, stop)


def rearranged(text: bytes, first: int, second: int, form: str, marks: tuple[bytes, bytes, bytes]) -> bytes:
    """The text cut at two bytes, with marks, in the order of `form`."""
    if form == PLAIN:
        return text
    p, s, m = marks
    buffer = bytearray(text)
    for at, mark in ((second, s), (first, m), (0, p)):
        buffer[at:at] = mark
    first, second = first + len(p), second + len(p) + len(m)
    exchange(buffer, first, second, len(buffer))
    if form == SPM:
        exchange(buffer, 0, first, first + len(buffer) - second)
    return bytes(buffer)


def restored(output: bytes, form: str, marks: tuple[bytes, bytes, bytes]) -> bytes:
    """The text that `rearranged` was given, by the opposite rotations in the opposite order."""
    if form == PLAIN:
        return output
    p, s, m = marks
    buffer = bytearray(output)
    if form == SPM:
        exchange(buffer, 0, buffer.index(p), buffer.index(m))
    first, second = buffer.index(s), buffer.index(m)
    exchange(buffer, first, second, len(buffer))
    second = first + len(buffer) - second
    for at, mark in ((second, s), (first, m), (0, p)):
        del buffer[at : at + len(mark)]
    return bytes(buffer)


def fill_in_middle(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    unit: str = LINES,
    percent: int = 100,
    spm_percent: int = 50,
    seed: int | str = 7,
    sentinels: Sentinels = Sentinels(),
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Every whole text cut into prefix, middle and suffix, put in the order of its form.

    A text has n units, the matches of `unit`, and whatever follows the last match belongs to
    the suffix. The first four 32-bit numbers of sha256 of `seed:key` decide: the first two,
    modulo n + 1, how many units stand before the middle and before the suffix; the third
    whether it is one of the `percent` of texts that change; the fourth whether it is one of the
    `spm_percent` in the order suffix, prefix, middle rather than prefix, suffix, middle.

    Returns `key`, `keep`, n (long), form (plain, psm or spm), prefix_chars and middle_chars
    (code points, null if plain) and output. A null text is an empty one. Empty texts and those
    that hold a sentinel stay plain. A null key counts as an empty string. Rows are neither
    shuffled nor merged: rows of one key are cut by the same numbers, and columns of `documents`
    that are not in `keep` may have any name. `restore` gives the texts back.
    """
    marks = sentinels.checked()
    names = [key, *keep]
    kinds = [documents.schema[c].dataType.simpleString() for c in names]
    out = ["n", "form", "prefix_chars", "middle_chars", "output"]
    schema = ", ".join(f"`{n}` {k}" for n, k in zip([*names, *out], [*kinds, "bigint", "string", "bigint", "bigint", "string"]))
    units = re.compile(unit)
    kept = [F.col(c).alias(str(i)) for i, c in enumerate(names, 2)]  # by place, as names may repeat
    rows = documents.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("0"), F.col(text).alias("1"), *kept)

    def cut(name: str, text: bytes) -> tuple[int, str, int | None, int | None, bytes]:
        words = text.decode()
        ends = np.fromiter((m.end() for m in units.finditer(words)), np.int64)
        n = len(ends)
        draws = struct.unpack(">4I", hashlib.sha256(f"{seed}:{name}".encode()).digest()[:16])
        if not text or draws[2] % 100 >= percent or any(m in text for m in marks):
            return n, PLAIN, None, None, text
        cuts = sorted(d % (n + 1) for d in draws[:2])
        first, second = (int(ends[c - 1]) if c else 0 for c in cuts)
        form = SPM if draws[3] % 100 < spm_percent else PSM
        before = len(words[:first].encode())
        output = rearranged(text, before, before + len(words[first:second].encode()), form, marks)
        return n, form, first, second - first, output

    def changed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bounded(whole, "1", _BATCH_BYTES):
                found = [cut(k, t) for k, t in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)))]
                n, form, prefix, middle, output = zip(*found)
                made = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64())]
                made += [pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*batch.columns[2:], *made], names=[*names, *out])

    return rows.mapInArrow(changed, schema)


def restore(
    changed: DataFrame, *, output: str = "output", form: str = "form", sentinels: Sentinels = Sentinels(), out: str = "restored"
) -> DataFrame:
    """`changed` with the text that every output was made of, told from output and form alone.

    A column that is already called `out` gives way. A null output is an empty text, a null form
    is plain; an output whose form needs a sentinel that is not there fails the job.
    """
    marks = sentinels.checked()
    kept = [c for c in changed.columns if c != out]
    kinds = [changed.schema[c].dataType.simpleString() for c in kept]
    schema = ", ".join(f"`{n}` {k}" for n, k in zip([*kept, out], [*kinds, "string"]))

    def back(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in bounded(whole, output, _BATCH_BYTES):
                rows = zip(texts_of(batch.column(output)), batch.column(form).to_pylist())
                texts = pa.array([restored(t, f or PLAIN, marks) for t, f in rows], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, texts.cast(pa.string())], names=[*kept, out])

    return changed.select(*kept).mapInArrow(back, schema)
