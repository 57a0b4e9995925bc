"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.storage import written
from millrace.llm.text import texts_of

BITS = 64
SEED = 42


def shingle_hashes(text: bytes, length: int) -> np.ndarray:
    """XXH64 of every run of `length` words joined by spaces, or of all words if they are fewer."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - length + 1)
    lasts = ends[min(length, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter([digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), lasts)], np.uint64, n)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes, as a signed 64-bit number."""
    if not len(hashes):
        return 0
    set_bits = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 14):
        octets = hashes[start : start + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    packed = np.packbits(set_bits * 2 > len(hashes))
    return int(packed.view(">i8")[0])


def fingerprints(
    documents: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 3, keep: tuple[str, ...] = ()
) -> DataFrame:
    """`key`, `keep` and the fingerprint (long) of every whole text; null and blank texts have zero."""
    names = [key, *keep]
    schema = ", ".join(f"`{n}` {documents.schema[n].dataType.simpleString()}" for n in names) + ", fingerprint bigint"

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(shingle_hashes(t, shingle)) for t in texts_of(batch.column(text))]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, names), pa.array(found, pa.int64())], names=[*names, "fingerprint"]
            )

    return documents.select(*names, text).mapInArrow(measure, schema)


def _masks(radius: int) -> list[int]:
    """All changes of at most `radius` bits, as signed 64-bit numbers."""
    found = []
    for r in range(radius + 1):
        for bits in combinations(range(BITS), r):
            mask = sum(1 << b for b in bits)
            found.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return found


def ball_links(points: DataFrame, distance: int) -> DataFrame:
    """Links (u, v) that connect what fingerprints at most `distance` bits apart connect.

    `points` has distinct fingerprints, each with a node. Every fingerprint emits all variants
    within half the distance, rounded up. Two that are no further apart than `distance` share
    a variant. Those that share one are linked to the smallest node among them if verified;
    where the distance is even the verification cannot fail, as two radii make up the distance,
    so the links connect whatever all pairs would connect. A variant is shared by as many
    fingerprints as its ball has, which does not depend on the data.

    With an odd distance half of it rounded up allows one bit too many; the pairs of a ball,
    bounded in the same way, are then verified one by one.
    """
    radius = (distance + 1) // 2
    variants = points.select(
        "node", "fingerprint", F.explode(F.array(*[F.lit(m) for m in _masks(radius)])).alias("mask")
    ).select("node", "fingerprint", F.col("fingerprint").bitwiseXOR(F.col("mask")).alias("variant"))
    shared = (
        variants.groupBy("variant")
        .agg(F.min("node").alias("u"), F.max("node").alias("v"), F.count("*").alias("n"))
        .where("n > 1")
    )
    shared = written(shared, "variants")
    if distance % 2 == 0:
        pairs = shared.select("u", "v")
        crowded = shared.where("n > 2").select("variant", "u")
        rest = variants.join(crowded, "variant").where("node <> u").select("u", F.col("node").alias("v"))
        return pairs.unionByName(rest).distinct()
    members = variants.join(shared.select("variant"), "variant").select("variant", "node", "fingerprint")
    others = members.select("variant", F.col("node").alias("v"), F.col("fingerprint").alias("other"))
    close = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("other"))) <= distance
    return members.join(others, "variant").where((F.col("node") < F.col("v")) & close).select(
        F.col("node").alias("u"), "v"
    ).distinct()


def represented(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    distance: int = 2,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """`key`, `keep`, fingerprint (long) and first, which stands for the group, of every document.

    first is the least (key, fingerprint) of the group. A node is a fingerprint with its smallest
    key, so rows that share a key but not a text are in the same group only if their texts are.
    """
    known = documents.where(F.col(key).isNotNull())
    marked = written(fingerprints(known, key=key, text=text, shingle=shingle, keep=keep), "fingerprints")
    node = F.struct(F.min(key).cast("long").alias("key"), F.col("fingerprint")).alias("node")
    points = written(marked.groupBy("fingerprint").agg(node), "points")
    reached = components(ball_links(points, distance))
    named = points.join(reached, "node", "left").select("fingerprint", F.coalesce("component", "node").alias("first"))
    return marked.join(named, "fingerprint").select(key, *keep, "fingerprint", "first")


def near_duplicates(
    documents: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 2
) -> DataFrame:
    """`key`, fingerprint (16 hexadecimal digits) and component_id of every document.

    Texts are lower-cased (A-Z), cut into words and shingles of `shingle` words, repeats
    included. Fingerprints at most `distance` bits apart link their documents; component_id is
    the smallest `key` (a whole number) that can be reached over links, the document's own
    included. Null and blank texts have fingerprint zero and link like any other. Rows with a
    null key are left out. Repeated rows stay and fall into one component; rows of one key with
    other texts are linked by their texts only. Other columns may have any name.

    Documents of equal fingerprint are one node, named by their smallest key, so groups of
    copies meet only in aggregates with partial results.
    """
    found = represented(documents, key=key, text=text, shingle=shingle, distance=distance)
    return found.select(
        key, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), F.col("first.key").alias("component_id")
    )
