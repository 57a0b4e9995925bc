"""A bounded sample of labelled documents, for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents that a classifier is fitted on, in expectation.
MAX_FITTED = 12_000


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of a key as text, modulo; -1 for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus, F.lit(-1))


def labelled_sample(
    documents: DataFrame, labels: DataFrame, *, key: str, text: str, label: str, fits: Column, max_rows: int
) -> DataFrame:
    """`key`, `text` and label (0 or 1) of labelled documents of which `fits` holds for the key.

    A key labelled several times gets the label of the majority, 1 on ties; null keys and labels
    are left out. Of more than `max_rows` keys a share is taken by a hash of the key, so that
    `max_rows` are expected; the chosen keys are therefore few enough to be broadcast.
    """
    known = (
        labels.select(F.col(key), F.col(label).cast("double").alias("label"))
        .dropna()
        .where(fits)
        .groupBy(key)
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    )
    n = known.count()
    if n > max_rows:
        bits = 1 << 30
        known = known.where(F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(bits)) < int(bits * max_rows / n))
    return documents.select(key, text).join(F.broadcast(known), key).select(key, text, "label")
