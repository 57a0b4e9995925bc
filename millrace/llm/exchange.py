"""Questions that chunks of a corpus put to all of it, in packed form.

A chunk holds some documents of together a few megabytes. It sums values for the distinct keys
among its own positions, sorts the keys and sends each range of them, as two blobs, to the
bucket that sums that range over all chunks. The bucket's answers go back in the order of the
keys. A key that a third of all positions share is one entry for each chunk, and keys are hashes,
so that buckets are even.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.storage import written
from millrace.llm.text import bounded, texts_of
from millrace.sources.scratch import scratch_path

CHUNK_BYTES = 4 << 20
#: Chunks that a task writes or reads at a time, however many a file holds.
CHUNKS_IN_HAND = 2
_BUCKET_BYTES = 12 << 20

REQUEST = "kind int, bucket int, chunk bigint, keys binary, sums binary"
_ANSWER = "kind int, bucket int, chunk bigint, found binary, counted array<double>"


def chunked(documents: DataFrame, columns: list[str], text: str, blob: Callable | None = None, name: str = "") -> DataFrame:
    """A written table of chunks: chunk, size (bytes), an array for each of `columns`, and texts.

    With `blob`, texts is what that makes of their list, compressed bytes (`unpacked`), and the
    table is one of the catalog, `name`, in buckets by chunk: joins by chunk do not shuffle it.
    """
    kinds = {c: documents.schema[c].dataType.simpleString() for c in columns}
    texts_kind = "binary" if blob else "array<binary>"
    schema = "chunk bigint, size bigint, " + "".join(f"`{c}` array<{k}>, " for c, k in kinds.items()) + f"texts {texts_kind}"

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in bounded(whole, text, CHUNK_BYTES):
                texts = texts_of(batch.column(text))
                arrays = [pa.array([number], pa.int64()), pa.array([sum(map(len, texts))], pa.int64())]
                ends = pa.array([0, batch.num_rows], pa.int32())
                arrays += [pa.ListArray.from_arrays(ends, batch.column(c)) for c in columns]
                lists = pa.array([compressed(blob(texts))]) if blob else pa.ListArray.from_arrays(ends, pa.array(texts, pa.binary()))
                arrays.append(lists)
                yield pa.RecordBatch.from_arrays(arrays, names=["chunk", "size", *columns, "texts"])
                number += 1

    chunks = documents.select(*dict.fromkeys([*columns, text])).mapInArrow(cut, schema)
    if not blob:
        return written(chunks, "chunks", rows_per_group=CHUNKS_IN_HAND)
    spark = documents.sparkSession
    writer = chunks.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk").sortBy("chunk")
    writer.option("compression", "zstd").option("path", scratch_path(spark, "chunks")).saveAsTable(name)
    return spark.table(name)


def bucket_count(chunks: DataFrame) -> int:
    """Buckets in proportion to the text."""
    return 1 + (chunks.agg(F.sum("size")).first()[0] or 0) // _BUCKET_BYTES


def asked(
    kind: int, chunk: int, keys: np.ndarray, sums: list[np.ndarray], buckets: int, coded: bool = False
) -> Iterator[tuple]:
    """Rows of REQUEST for sorted distinct `keys`; each of `sums` is of eight-byte numbers.

    If `coded`, keys go as distances, and all numbers by planes; `answers` must be told.
    """
    top = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    cuts = np.searchsorted(top, np.arange(buckets + 1, dtype=np.uint64))
    for b in range(buckets):
        a, z = cuts[b], cuts[b + 1]
        if z > a:
            if coded:
                distances = np.diff(keys[a:z], prepend=np.uint64(0))
                yield kind, b, chunk, _packed([planes(distances)]), _packed([planes(s[a:z]) for s in sums])
            else:
                yield kind, b, chunk, keys[a:z].tobytes(), _packed([s[a:z] for s in sums])


def planes(numbers: np.ndarray) -> np.ndarray:
    """All first bytes of some numbers, then all second ones: those that are mostly 0 compress well."""
    return np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.dtype.itemsize).T


def from_planes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _keys_of(data: bytes, coded: bool) -> np.ndarray:
    return from_planes(unpacked(data), np.uint64).cumsum(dtype=np.uint64) if coded else np.frombuffer(data, np.uint64)


def _sums_of(data: bytes, n: int, coded: bool) -> np.ndarray:
    if not coded:
        return np.frombuffer(unpacked(data), np.float64).reshape(-1, n)
    parts = np.frombuffer(unpacked(data), np.uint8).reshape(-1, 8 * n)
    return np.stack([from_planes(part, np.float64) for part in parts])


def _packed(columns: list[np.ndarray]) -> bytes:
    """Columns one after the other, compressed: most counts are small and alike."""
    return compressed(b"".join(np.ascontiguousarray(c).tobytes() for c in columns))


def compressed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows as a batch; the types of `schema` that are used here."""
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}
    fields = [f.rsplit(" ", 1) for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields]
    )


def answers(requests: DataFrame, answer: Callable, label: str, coded: bool = False) -> tuple[DataFrame, dict[int, list[float]]]:
    """The buckets' answers, written: one row for each chunk with found, an array of
    (kind, bucket, found). With them the sums of what the buckets counted, by kind.

    `answer(kind, inverse, sums, first, own)` gets for all entries of a bucket the number of their
    key, the sums over equal keys (by number, a matrix with a row for each of the sums), the
    entries that are the first of their key, and what each entry gave to the sums. It returns columns for the entries, of eight bytes
    or one byte a value, and a list of numbers that are added up over all buckets.
    """

    def answered(table: pa.Table) -> pa.Table:
        kind, bucket = table.column("kind")[0].as_py(), table.column("bucket")[0].as_py()
        keys = [_keys_of(k, coded) for k in table.column("keys").to_pylist()]
        sizes = np.array([len(k) for k in keys])
        raw = table.column("sums").to_pylist()
        parts = [_sums_of(r, n, coded) for r, n in zip(raw, sizes)]
        distinct, at, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        own = np.concatenate(parts, axis=1)
        sums = np.stack([np.bincount(inverse, row, len(distinct)) for row in own])
        first = np.zeros(len(inverse), bool)
        first[at] = True
        columns, counted = answer(kind, inverse, sums, first, own)
        rows, start = [], 0
        for chunk, n in zip(table.column("chunk").to_pylist(), sizes.tolist()):
            found = _packed([c[start : start + n] for c in columns])
            rows.append((kind, bucket, chunk, found, counted if start == 0 else None))
            start += n
        return pa.Table.from_batches([batch_of(rows, _ANSWER)])

    made = written(requests.groupBy("kind", "bucket").applyInArrow(answered, _ANSWER), label, 1)
    counted = made.where("counted IS NOT NULL").select("kind", F.posexplode("counted").alias("place", "value"))
    totals: dict[int, list[float]] = {}
    for row in counted.groupBy("kind", "place").agg(F.sum("value").alias("value")).orderBy("kind", "place").collect():
        totals.setdefault(row["kind"], []).append(row["value"])
    found = made.groupBy("chunk").agg(F.collect_list(F.struct("kind", "bucket", "found")).alias("found"))
    return found, totals


def joined(chunks: DataFrame, found: list[DataFrame]) -> DataFrame:
    """Chunks with all of their answers in one array, empty for a chunk that had no question."""
    if not found:
        return chunks.withColumn("found", F.expr("CAST(array() AS array<struct<kind:int,bucket:int,found:binary>>)"))
    for i, f in enumerate(found):
        chunks = chunks.join(f.withColumnRenamed("found", f"found_{i}"), "chunk", "left")
    arrays = [F.coalesce(f"found_{i}", F.expr("CAST(array() AS array<struct<kind:int,bucket:int,found:binary>>)")) for i in range(len(found))]
    return chunks.withColumn("found", F.concat(*arrays)).drop(*(f"found_{i}" for i in range(len(found))))


def received(found: list[dict], kind: int, kinds: list[type]) -> list[np.ndarray]:
    """The columns of the answers to one kind of question, in the order of the keys."""
    width = sum(np.dtype(k).itemsize for k in kinds)
    parts: list[list[np.ndarray]] = [[] for _ in kinds]
    for row in sorted((r for r in found if r["kind"] == kind), key=lambda r: r["bucket"]):
        data = unpacked(row["found"])
        n, start = len(data) // width, 0
        for part, k in zip(parts, kinds):
            part.append(np.frombuffer(data, k, n, start))
            start += n * np.dtype(k).itemsize
    return [np.concatenate([np.zeros(0, k), *p]) for p, k in zip(parts, kinds)]
