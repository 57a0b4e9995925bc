"""Token ids in seekable zstandard files, written and read by tasks.

A file is a run of independent zstandard frames. The data frames hold ids, 4 bytes each, low
byte first; a document that fits in a frame is in one frame. A skippable frame follows with the
directory of the documents (key and number of ids, as an Arrow stream), and then, as another
skippable frame, the seek table of the public "seekable format": sizes and the low 32 bits of
the XXH64 of every frame's content. Any zstandard decoder therefore reads the ids as one stream,
while a reader of one document fetches and decompresses only the frames that hold it.
"""

from __future__ import annotations

import io
import json
import os
import re
import struct
from array import array
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.storage import written
from millrace.llm.text import bounded, texts_of
from millrace.sources.scratch import scratch_path

#: Fixed values of the seekable format.
SEEK_TABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
#: A skippable frame of our own.
DIRECTORY_MAGIC = 0x184D2A50

FRAME_IDS = 1 << 16
PART_BYTES = 64 << 20
_UNIT_IDS = 4 << 20
_BATCH_BYTES = 4 << 20
_KNOWN_PIECES = 500_000
_KNOWN_IDS = 8 << 20
#: Letters of ASCII and U+00C0 to U+00FF, which have no other form under NFC, then other printed ASCII.
_SIMPLE = re.compile(rb"((?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+)([!-/:-@\[-`{-~]*)")
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
#: How byte-level vocabularies write the bytes that are no printed characters of Latin-1.
_BYTE_LETTERS = dict(zip((b for b in range(256) if b not in _PRINTED), count(256)))
#: Steps before the model that leave lower-cased letters of ASCII as one word.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
_LEVEL = 3


class Encoder:
    """Ids of texts as bytes, by a tokenizer that drops white space.

    No token crosses white space, so texts are cut there and known pieces are looked up. Where
    normalizer and pre-tokenizer are the ones below, a piece of letters up to U+00FF and a few
    marks after it is one word of lower-cased letters, whose bytes go to the model as they are,
    and the marks. All other new pieces go through the whole tokenizer.
    """

    def __init__(self, definition: str, end: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_str(definition)
        self._model = self._tokenizer.model
        parts = json.loads(definition)
        added = [t["content"].encode() for t in parts["added_tokens"]]
        known = parts["normalizer"] == _NORMALIZER and parts["pre_tokenizer"] == _PRE_TOKENIZER
        self._direct = known and not any(_SIMPLE.fullmatch(t) for t in added)
        self._end = end
        self._forget()

    def _forget(self) -> None:
        """Piece 0 is the end of a document."""
        self._numbers: dict[bytes | None, int] = defaultdict(count().__next__)
        self._numbers[None]
        self._words: dict[str, bytes] = {}
        self._values = np.array([self._end], "<u4")
        self._starts = np.zeros(1, np.int64)
        self._sizes = np.ones(1, np.int64)

    def _encoded(self, pieces: list[bytes]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _word(self, letters: bytes) -> bytes:
        word = letters.decode().lower()
        ids = self._words.get(word)
        if ids is None:
            tokens = self._model.tokenize(word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_LETTERS))
            ids = self._words[word] = array("I", [t.id for t in tokens]).tobytes()
        return ids

    def _learn(self) -> None:
        fresh = list(islice(self._numbers, len(self._sizes), None))
        simple = [_SIMPLE.fullmatch(p) if self._direct else None for p in fresh]
        other = [p for p, m in zip(fresh, simple) if m is None]
        other += {m[2] for m in simple if m is not None and m[2]}
        whole = dict(zip(other, self._encoded(other))) | {b"": b""}
        word = self._word
        found = [whole[p] if m is None else word(m[1]) + whole[m[2]] for p, m in zip(fresh, simple)]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        values = np.frombuffer(b"".join(found), np.uintc).astype("<u4")
        self._starts = np.concatenate([self._starts, len(self._values) + np.cumsum(sizes) - sizes])
        self._sizes = np.concatenate([self._sizes, sizes])
        self._values = np.concatenate([self._values, values])

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        if len(self._numbers) > _KNOWN_PIECES or len(self._values) > _KNOWN_IDS:
            self._forget()
        cut = [t.split() for t in texts]
        n = np.fromiter(map(len, cut), np.int64, len(cut)) + 1
        at = np.zeros(int(n.sum()), np.int64)
        number = self._numbers.__getitem__
        place = 0
        for pieces in cut:  # the end, which is 0, stays behind each text
            at[place : place + len(pieces)] = np.fromiter(map(number, pieces), np.int64, len(pieces))
            place += len(pieces) + 1
        self._learn()
        sizes = self._sizes[at]
        ends = np.cumsum(sizes)
        ids = self._values[np.repeat(self._starts[at] - ends + sizes, sizes) + np.arange(int(sizes.sum()))]
        stops = ends[np.cumsum(n) - 1].tolist()
        return [ids[a:b].tobytes() for a, b in zip([0, *stops], stops)]


class FileWriter:
    """Writes one file; documents come in the order in which they are to stand there."""

    def __init__(self, out, frame_ids: int = FRAME_IDS) -> None:
        self._out = out
        self._frame_bytes = 4 * frame_ids
        self._compressor = zstandard.ZstdCompressor(level=_LEVEL)
        self._held = bytearray()
        self._entries: list[tuple[int, int, int]] = []
        self._keys: list[pa.Array] = []
        self._sizes: list[int] = []

    def _frame(self, content: bytes) -> None:
        packed = self._compressor.compress(content)
        self._out.write(packed)
        self._entries.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def add(self, keys: pa.Array, documents: list[bytes]) -> None:
        self._keys.append(keys)
        for ids in documents:
            self._sizes.append(len(ids) // 4)
            if self._held and len(self._held) + len(ids) > self._frame_bytes:
                self._frame(bytes(self._held))
                self._held.clear()
            start = 0
            while len(ids) - start > self._frame_bytes:
                self._frame(ids[start : start + self._frame_bytes])
                start += self._frame_bytes
            self._held += ids[start:] if start else ids

    def close(self) -> tuple[int, int]:
        """Documents and ids in the file, which ends with directory and seek table now."""
        if self._held:
            self._frame(bytes(self._held))
        table = pa.table({"key": pa.chunked_array(self._keys), "n": pa.array(self._sizes, pa.int64())})
        stream = io.BytesIO()
        with pa.ipc.new_stream(stream, table.schema) as directory:
            directory.write_table(table)
        packed = zstandard.ZstdCompressor(level=_LEVEL, write_checksum=True).compress(stream.getvalue())
        self._out.write(struct.pack("<II", DIRECTORY_MAGIC, len(packed)) + packed)
        self._entries.append((8 + len(packed), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        rows = b"".join(struct.pack("<III", *e) for e in self._entries)
        footer = struct.pack("<IBI", len(self._entries), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self._out.write(struct.pack("<II", SEEK_TABLE_MAGIC, len(rows) + len(footer)) + rows + footer)
        return len(self._sizes), sum(self._sizes)


class FileReader:
    """Reads documents of one file; `frames_read` counts the data frames that it decompressed."""

    def __init__(self, source) -> None:
        self._source = source
        source.seek(0, 2)
        end = source.tell()
        count, flags, magic = struct.unpack("<IBI", self._bytes(end - 9, 9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        size = 12 * count + 9
        table = self._bytes(end - size - 8, size + 8)
        if struct.unpack("<II", table[:8]) != (SEEK_TABLE_MAGIC, size):
            raise ValueError("the seek table is damaged")
        entries = np.frombuffer(table, "<u4", 3 * count, 8).reshape(count, 3).astype(np.int64)
        self._packed, self._content, self._sums = entries.T
        self._at = np.cumsum(self._packed) - self._packed
        self._ends = np.cumsum(self._content[:-1]) // 4
        self._last: tuple[int, np.ndarray] = (-1, np.zeros(0, "<u4"))
        self.frames_read = 0
        directory = self._bytes(int(self._at[-1]), int(self._packed[-1]))
        if struct.unpack("<II", directory[:8]) != (DIRECTORY_MAGIC, len(directory) - 8):
            raise ValueError("the directory is damaged")
        listed = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(directory[8:])).read_all()
        self.keys = listed.column("key").combine_chunks()
        self.sizes = listed.column("n").to_numpy()
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _bytes(self, at: int, size: int) -> bytes:
        self._source.seek(at)
        return self._source.read(size)

    def _frame(self, i: int) -> np.ndarray:
        if self._last[0] != i:
            packed = self._bytes(int(self._at[i]), int(self._packed[i]))
            content = zstandard.ZstdDecompressor().decompress(packed, max_output_size=int(self._content[i]))
            if len(content) != self._content[i] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self._sums[i]:
                raise ValueError(f"frame {i} does not have the content that its checksum is of")
            self.frames_read += 1
            self._last = i, np.frombuffer(content, "<u4")
        return self._last[1]

    def document(self, place: int) -> bytes:
        """The ids of the document at a place in the file."""
        start, stop = int(self.starts[place]), int(self.starts[place] + self.sizes[place])
        parts, i = [], int(np.searchsorted(self._ends, start, side="right"))
        while start < stop:
            before = int(self._ends[i - 1]) if i else 0
            some = self._frame(i)[start - before : stop - before]
            parts.append(some.tobytes())
            start, i = start + len(some), i + 1
        return b"".join(parts)


def _opened(path: str) -> tuple[FileSystem, str]:
    """The file system of a path with or without a scheme."""
    return FileSystem.from_uri(re.sub("^file:/+", "/", path))


def write_token_files(
    documents: DataFrame,
    definition: str,
    *,
    end: int,
    key: str = "doc_id",
    text: str = "text",
    folder: str | None = None,
    frame_ids: int = FRAME_IDS,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Encode every whole text, end it with the id `end`, and write all in ascending order of `key`.

    `definition` is a tokenizer of the tokenizers library as JSON, which must drop white space;
    special tokens are not added. Returns one row for each file: part (their order), path, first
    and last (key), n_docs, n_ids and start (the ids in all files before it). Null texts are
    empty and have the end alone; null keys come first; rows of one key stand in the order of a
    hash of their text, and equal rows one after the other. Without rows there are no files.
    Other columns may have any name.

    Rows are dealt out by ranges of (key, hash of the text, place in the input), so that a key
    with a large part of all rows is split, in parts of `part_bytes` of text. A task writes its
    own file in `folder` (a new one in the shared folder by default) through pyarrow, which knows
    local and mounted folders, s3, gs, abfs and hdfs. The name holds the attempt, and only
    files of attempts that Spark has taken are in the result: a task that is lost and run again
    leaves a file that nothing refers to.
    """
    spark = documents.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    size = documents.select(F.sum(F.octet_length(text))).first()[0] or 0
    place = F.monotonically_increasing_id()
    rows = documents.select(F.col(key).alias("key"), F.xxhash64(text).alias("copy"), place.alias("place"), F.col(text).alias("text"))
    order = ["key", "copy", "place"]
    dealt = rows.repartitionByRange(1 + size // part_bytes, *order).sortWithinPartitions(*order).select("key", "text")
    shared = spark.sparkContext.broadcast(definition)
    kind = documents.schema[key].dataType.simpleString()

    def save(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, context, out = None, TaskContext.get(), None
        path = f"{folder}/part-{context.partitionId():06d}-{context.taskAttemptId()}.zst"
        first = last = None
        for whole in batches:
            for batch in bounded(whole, "text", _BATCH_BYTES):
                if out is None:
                    filesystem, name = _opened(path)
                    filesystem.create_dir(os.path.dirname(name), recursive=True)
                    out = filesystem.open_output_stream(name, compression=None)
                    writer, encode = FileWriter(out, frame_ids), Encoder(shared.value, end)
                    first = batch.column(0).slice(0, 1)
                last = batch.column(0).slice(batch.num_rows - 1)
                writer.add(batch.column(0), encode(texts_of(batch.column(1))))
        if out is not None:
            n_docs, n_ids = writer.close()
            out.close()
            numbers = [pa.array([v], pa.int64()) for v in (n_docs, n_ids)]
            names = ["part", "path", "first", "last", "n_docs", "n_ids"]
            yield pa.RecordBatch.from_arrays([pa.array([context.partitionId()], pa.int32()), pa.array([path]), first, last, *numbers], names=names)

    schema = f"part int, path string, first {kind}, last {kind}, n_docs bigint, n_ids bigint"
    files = written(dealt.mapInArrow(save, schema), "token-file-list")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


_READ = ["start", "n_tokens", "ids"]


def _batches(reader: FileReader, places: Iterable[int], start: int, key: str) -> Iterator[pa.RecordBatch]:
    def made() -> pa.RecordBatch:
        at = np.array(held, np.int64)
        columns = [reader.keys.take(pa.array(at)), pa.array(start + reader.starts[at]), pa.array(reader.sizes[at])]
        return pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.binary())], names=[key, *_READ])

    held, ids, size = [], [], 0
    for place in places:
        held.append(place)
        ids.append(reader.document(place))
        size += len(ids[-1])
        if size >= _BATCH_BYTES:
            yield made()
            held, ids, size = [], [], 0
    if held:
        yield made()


def _schema(files: DataFrame, key: str) -> str:
    return f"`{key}` {files.schema['first'].dataType.simpleString()}, start bigint, n_tokens bigint, ids binary"


def read_token_files(files: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """All documents of the files that `write_token_files` lists.

    Returns `key`, start (the ids of all documents before it), n_tokens and ids (binary, 4 bytes
    each). Files are dealt out in units of documents with about 16 MB of ids; every frame that is
    read is held against its checksum.
    """
    parts = F.greatest(F.lit(1), F.ceil(F.col("n_ids") / _UNIT_IDS)).cast("long")
    units = files.select("path", "start", "n_docs", parts.alias("parts"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("i"))
    n = files.select(F.sum(parts)).first()[0] or 1

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit in batch.to_pylist():
                filesystem, name = _opened(unit["path"])
                with filesystem.open_input_file(name) as source:
                    ends = [unit["n_docs"] * i // unit["parts"] for i in (unit["i"], unit["i"] + 1)]
                    yield from _batches(FileReader(source), range(*ends), unit["start"], key)

    return units.repartition(n).mapInArrow(read, _schema(files, key))


def read_documents(files: DataFrame, wanted: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """Only the documents whose key is in `wanted`, in the columns of `read_token_files`.

    A key that several documents have gives all of them; one that is asked for several times
    counts once; null and unknown keys give nothing. Keys go to the files whose range holds them,
    in order, and a task decompresses only the frames that hold its documents. The ranges, one row
    for each part of 64 MB of text, go to all tasks.
    """
    listed = files.where(F.col("last").isNotNull()).orderBy("part").select("path", "start", "first", "last").toArrow()
    shared = files.sparkSession.sparkContext.broadcast(listed)
    kind = files.schema["first"].dataType
    keys = wanted.select(F.col(key).cast(kind).alias("key")).where(F.col("key").isNotNull()).distinct()

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, lasts = (shared.value.column(c).to_pylist() for c in ("first", "last"))
        for batch in batches:
            files_, places = [], []
            for row, k in enumerate(batch.column(0).to_pylist()):
                i = bisect_left(lasts, k)
                while i < len(lasts) and (firsts[i] is None or firsts[i] <= k):
                    files_.append(i)
                    places.append(row)
                    i += 1
            found = [pa.array(files_, pa.int32()), batch.column(0).take(pa.array(places, pa.int64()))]
            yield pa.RecordBatch.from_arrays(found, names=["file", "key"])

    asked = keys.mapInArrow(find, f"file int, key {kind.simpleString()}")
    dealt = asked.repartitionByRange("file", "key").sortWithinPartitions("file", "key")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = reader = source = places = None
        for batch in batches:
            rows = defaultdict(list)
            for file, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows[file].append(k)
            for file, asked_for in rows.items():
                path, start = (shared.value.column(c)[file].as_py() for c in ("path", "start"))
                if file != held:
                    if source is not None:
                        source.close()
                    filesystem, name = _opened(path)
                    held, source = file, filesystem.open_input_file(name)
                    reader, places = FileReader(source), defaultdict(list)
                    for place, k in enumerate(reader.keys.to_pylist()):
                        places[k].append(place)
                yield from _batches(reader, (p for k in asked_for for p in places.get(k, ())), start, key)
        if source is not None:
            source.close()

    return dealt.mapInArrow(read, _schema(files, key))
