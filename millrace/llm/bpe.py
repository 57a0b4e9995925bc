"""Byte-level BPE: recursive queries of DuckDB, one connection for each task that encodes."""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import count, islice

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from millrace.llm.text import bounded, texts_of

#: Bytes of text in hand at a time, words in one recursive query, words and pieces remembered by a task.
_BATCH_BYTES = 1 << 20
_QUERY_WORDS = 5_000
_KNOWN_WORDS = 600_000
_LONG_WORD = 64
_PART_TOKENS = 1 << 16

_SETUP = """
    CREATE TABLE merges AS
      WITH cuts AS (
        SELECT id, bytes, unnest(generate_series(1, octet_length(bytes) - 1)) AS k FROM given)
      SELECT (a.id::BIGINT << 20) | b.id AS pair, c.id::BIGINT AS rank, twice.id IS NULL OR twice.id > c.id AS calm,
        2 + max(octet_length(c.bytes)) OVER (ORDER BY c.id) AS reach
      FROM cuts c JOIN given a ON a.bytes = c.bytes[:c.k] JOIN given b ON b.bytes = c.bytes[c.k + 1:]
      LEFT JOIN given twice ON twice.bytes = unhex(repeat(hex(c.bytes), 2));
"""

#: Every step puts the tokens of the open words in rows by position, looks up adjacent pairs, and
#: contracts the pair of least rank, the leftmost of equals. A word without a pair is done.
_ENCODE = """
    WITH RECURSIVE step(word, ids, live) {key} AS (
      SELECT word, ids, true FROM words
      {union}
      (WITH rows AS (
         SELECT word, spot, (ids[spot]::BIGINT << 20) | ids[spot + 1] AS pair
         FROM (SELECT word, ids, unnest(generate_series(1, len(ids) - 1)) AS spot FROM step WHERE live)),
       least AS (
         SELECT word, min((rank::BIGINT << 32) | spot) AS found
         FROM rows JOIN merges USING (pair) GROUP BY word),
       cut AS (
         SELECT word, ids, (found >> 32)::INTEGER AS rank, found & 4294967295 AS spot
         FROM step LEFT JOIN least USING (word) WHERE live)
       SELECT word,
         CASE WHEN rank IS NULL THEN ids ELSE ids[:spot - 1] || [rank] || ids[spot + 2:] END,
         rank IS NOT NULL
       FROM cut))
    SELECT word, ids FROM step WHERE NOT live ORDER BY word
"""
#: Short words keep all of their states until the query ends, which is faster. Of long ones only
#: the last state is kept, so that a word of any length takes the room of its tokens.
_SHORT = _ENCODE.format(key="", union="UNION ALL")

#: Long words contract many pairs a step. A pair is smooth if contracting it makes no pair of lower
#: rank with the tokens beside it, nor of two of the new tokens. Until the turn of a pair p comes,
#: only pairs of p's rank at most are contracted. So if no other within `reach` places, two more
#: than the bytes of the longest token up to that rank, has a lower rank, and all of equal rank
#: there are smooth, a merge elsewhere could touch p's surroundings only through a token that reaches that far, and p,
#: if smooth, may be contracted now. Of a run of pairs of equal rank, each overlapping the next,
#: these are the first, third, fifth and so on, if this holds around the run's first too. The pair
#: whose turn it is goes in any case.
_LONG = """
    WITH RECURSIVE step(word, ids, live) USING KEY (word) AS (
      SELECT word, ids, true FROM words
      UNION
      (WITH tokens AS (
         SELECT word, unnest(generate_series(1, len(ids))) AS spot, unnest(ids)::BIGINT AS id FROM step WHERE live),
       sides AS (
         SELECT word, spot, id, lag(id) OVER w AS before, lead(id) OVER w AS next, lead(id, 2) OVER w AS after
         FROM tokens WINDOW w AS (PARTITION BY word ORDER BY spot)),
       ranked AS (
         SELECT s.word, s.spot, s.id, m.rank, coalesce(m.reach, 0) AS reach,
           m.rank * 2 + (m.calm AND coalesce(l.rank > m.rank, true) AND coalesce(r.rank > m.rank, true))::BIGINT AS score
         FROM sides s LEFT JOIN merges m ON m.pair = (s.id << 20) | s.next
         LEFT JOIN merges l ON l.pair = (s.before << 20) | m.rank
         LEFT JOIN merges r ON r.pair = (m.rank << 20) | s.after),
       around AS (
         SELECT word, spot, id, rank,
           (rank << 32) | spot = min((rank << 32) | spot) OVER (PARTITION BY word) AS due,
           score % 2 = 1 AND score = min(score) OVER (w ROWS BETWEEN reach PRECEDING AND reach FOLLOWING) AS least,
           lag(score) OVER w IS DISTINCT FROM score AS opens
         FROM ranked WINDOW w AS (PARTITION BY word ORDER BY spot)),
       runs AS (
         SELECT word, spot, id, rank, due, least,
           max(CASE WHEN opens THEN spot * 2 + coalesce(least, false)::BIGINT END) OVER (
             PARTITION BY word ORDER BY spot ROWS UNBOUNDED PRECEDING) AS run
         FROM around),
       chosen AS (
         SELECT word, spot, id, rank,
           coalesce(due OR (least AND run % 2 = 1 AND (spot - run // 2) % 2 = 0), false) AS joined FROM runs),
       cut AS (
         SELECT word, spot, CASE WHEN joined THEN rank ELSE id END AS id, joined,
           coalesce(lag(joined) OVER (PARTITION BY word ORDER BY spot), false) AS gone
         FROM chosen)
       SELECT word, list(id::INTEGER ORDER BY spot) FILTER (NOT gone), bool_or(joined) FROM cut GROUP BY word))
    SELECT word, ids FROM step WHERE NOT live ORDER BY word
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """A file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class _Lists:
    """Lists of numbers one after the other, with their starts and sizes."""

    def __init__(self, kind: type = np.int32) -> None:
        self.values = np.zeros(0, kind)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.values) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.values = np.concatenate([self.values, values])

    def joined(self, at: np.ndarray) -> np.ndarray:
        """The lists `at`, one after the other."""
        sizes = self.sizes[at]
        shift = self.starts[at] - (np.cumsum(sizes) - sizes)
        return self.values[np.repeat(shift, sizes) + np.arange(sizes.sum())]


class Tokenizer:
    """Encodes and decodes the texts of one task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self._ranks = ranks
        self._pattern = regex.compile(pattern)
        self._forget()

    @cached_property
    def _db(self) -> duckdb.DuckDBPyConnection:
        """Only tasks that encode have one."""
        db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        given = pa.table({"id": pa.array(self._ranks.values(), pa.int32()), "bytes": pa.array(self._ranks, pa.binary())})
        db.register("given", given)
        db.execute(_SETUP)
        return db

    @cached_property
    def _byte(self) -> np.ndarray:
        return np.array([self._ranks[bytes([b])] for b in range(256)], np.int32)

    @cached_property
    def _vocabulary(self) -> tuple[np.ndarray, _Lists]:
        """All ids in order, and their tokens; behind these an empty one, for ids without a token."""
        ids, tokens = np.fromiter(self._ranks.values(), np.int64, len(self._ranks)), list(self._ranks)
        order = np.argsort(ids)
        lists = _Lists(np.uint8)
        sizes = [len(tokens[i]) for i in order]
        lists.add(np.frombuffer(b"".join(tokens[i] for i in order), np.uint8), np.array([*sizes, 0], np.int64))
        return ids[order], lists

    def _forget(self) -> None:
        self._words: dict[str, int] = defaultdict(count().__next__)
        self._word_ids = _Lists()
        self._pieces: dict[str, int] = defaultdict(count().__next__)
        self._piece_ids = _Lists()
        self._spaced = np.zeros(0, bool)

    def _encoded(self, words: list[str]) -> list[np.ndarray]:
        raw = [w.encode() for w in words]
        found: list = [self._ranks.get(w) for w in raw]
        todo = [i for i, f in enumerate(found) if f is None]
        found = [f if f is None else np.array([f], np.int32) for f in found]
        for query, some in (
            (_SHORT, [i for i in todo if len(raw[i]) <= _LONG_WORD]),
            (_LONG, [i for i in todo if len(raw[i]) > _LONG_WORD]),
        ):
            for start in range(0, len(some), _QUERY_WORDS):
                part = some[start : start + _QUERY_WORDS]
                for i, ids in zip(part, self._contracted(query, [raw[i] for i in part])):
                    found[i] = ids
        return found

    def _contracted(self, query: str, words: list[bytes]) -> list[np.ndarray]:
        ends = np.concatenate([[0], np.cumsum([len(w) for w in words])])
        bytes_ = self._byte[np.frombuffer(b"".join(words), np.uint8)]
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bytes_))
        self._db.register("words", pa.table({"word": pa.array(np.arange(len(words))), "ids": ids}))
        column = self._db.sql(query).to_arrow_table().column("ids").combine_chunks()
        values, offsets = np.asarray(column.values), np.asarray(column.offsets)
        return [values[a:b] for a, b in zip(offsets, offsets[1:])]

    def _cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the matches in all texts, and how many each text has."""
        matches = [self._pattern.findall(t) for t in texts]
        sizes = np.fromiter(map(len, matches), np.int64, len(matches))
        number = self._words.__getitem__
        at = np.fromiter((number(w) for m in matches for w in m), np.int64, int(sizes.sum()))
        fresh = list(islice(self._words, len(self._word_ids.sizes), None))
        if fresh:
            ids = self._encoded(fresh)
            self._word_ids.add(np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids)))
        return at, sizes

    def _learn(self) -> None:
        """Token ids of the pieces numbered since the last call, each with a space before it."""
        fresh = list(islice(self._pieces, len(self._spaced), None))
        spaced = [not p or p[0].isspace() or p[-1].isspace() for p in fresh]
        self._spaced = np.concatenate([self._spaced, np.array(spaced, bool)])
        at, sizes = self._cut([" " + p for p in fresh])
        ends = np.concatenate([[0], np.cumsum(self._word_ids.sizes[at])])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        self._piece_ids.add(self._word_ids.joined(at), np.diff(ends[bounds]))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text.

        A text is cut before each space. Where no other white space is beside these spaces, no
        match of the pattern crosses the cuts, and the ids of known pieces are looked up; any
        other text is matched as a whole.
        """
        if len(self._words) + len(self._pieces) > _KNOWN_WORDS:
            self._forget()
        number = self._pieces.__getitem__
        heads, tails = [], []
        for t in texts:
            head, *rest = t.split(" ")
            heads.append(head)
            tails.append(np.fromiter(map(number, rest), np.int64, len(rest)))
        self._learn()
        for i, (t, tail) in enumerate(zip(texts, tails)):
            if len(tail) and (heads[i][-1:].isspace() or self._spaced[tail].any()):
                heads[i], tails[i] = t, tail[:0]
        at, sizes = self._cut(heads)
        starts = np.cumsum(sizes) - sizes
        return [
            np.concatenate([self._word_ids.joined(at[a : a + n]), self._piece_ids.joined(tail)])
            for a, n, tail in zip(starts, sizes, tails)
        ]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of every list of ids."""
        known, tokens = self._vocabulary
        flat = np.concatenate([np.zeros(0, np.int32), *ids])
        parts, ends = [], [np.zeros(1, np.int64)]
        for start in range(0, len(flat), _PART_TOKENS):
            part = flat[start : start + _PART_TOKENS]
            at = np.searchsorted(known, part)
            at[np.append(known, -1)[at] != part] = len(known)
            parts.append(tokens.joined(at).tobytes())
            ends.append(ends[-1][-1] + np.cumsum(tokens.sizes[at]))
        whole, bounds = b"".join(parts), np.concatenate(ends)[np.cumsum([0, *map(len, ids)])].tolist()
        return [whole[a:z] for a, z in zip(bounds, bounds[1:])]


def _mapped(df: DataFrame, column: str, out: str, kind: str, ranks: dict[bytes, int], pattern: str, work) -> DataFrame:
    """`df` with one more column, or another in its place, that `work` makes of batches."""
    if out in df.columns and out != column:
        df = df.drop(out)
    if column not in df.columns:
        raise ValueError(f"no column {column}")
    shared = df.sparkSession.sparkContext.broadcast((ranks, pattern))
    names = [*(c for c in df.columns if c != out), out]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema} | {out: kind}
    schema = ", ".join(f"`{n}` {kinds[n]}" for n in names)

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(*shared.value)
        for whole in batches:
            for batch in bounded(whole, column, _BATCH_BYTES):
                made = pa.array(work(tokenizer, texts_of(batch.column(column))), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(n) for n in names[:-1]] + [made], names=names)

    return df.mapInArrow(mapped, schema)


def encode(documents: DataFrame, ranks: dict[bytes, int], pattern: str, *, text: str = "text", out: str = "ids") -> DataFrame:
    """`documents` with the token ids of every whole text, 4 bytes each, low byte first.

    The matches of `pattern` are encoded separately, without special tokens. A match that is a
    token is that token; others start as single bytes, and their leftmost pair of least rank is
    contracted until no pair is left. Null and empty texts have no ids. Rows keep their order
    and number; all other columns stay, except one that is already called `out`.
    """

    def work(tokenizer: Tokenizer, texts: list[bytes]) -> list[bytes]:
        return [x.astype("<u4").tobytes() for x in tokenizer.encode([t.decode() for t in texts])]

    return _mapped(documents, text, out, "binary", ranks, pattern, work)


def decode(encoded: DataFrame, ranks: dict[bytes, int], *, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """`encoded` with the bytes that the ids of every row stand for; null is an empty list.

    An id that is not in `ranks` stands for nothing and is left out.
    """

    def work(tokenizer: Tokenizer, rows: list[bytes]) -> list[bytes]:
        return tokenizer.decode([np.frombuffer(x, "<u4").astype(np.int32) for x in rows])

    return _mapped(encoded, ids, out, "binary", ranks, "", work)
