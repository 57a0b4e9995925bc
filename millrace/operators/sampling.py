"""Samples, splits and folds that a rerun, a retry or another cluster repeats exactly.

Every choice hashes a unique key of the row together with a seed. Tables without a key can
be sampled and split by Spark's own generator, which depends on how the rows happen to be
partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import col
from millrace.functions.hashing import hash_uniform
from millrace.operators.sizes import broadcast_if, few_groups

STRATUM_BUCKETS = 1 << 16


def sample(df: DataFrame, fraction: float, key: str | None, seed: int | str) -> DataFrame:
    """Keep each row with the given probability, without replacement."""
    if key is None:
        return df.sample(withReplacement=False, fraction=fraction, seed=int(seed))
    return df.filter(hash_uniform(col(key), seed) < fraction)


def split_column(key: str, fractions: Sequence[float], seed: int | str) -> Column:
    """Number of the part a row falls in, parts being in proportion to `fractions`."""
    total, reached, u = sum(fractions), 0.0, hash_uniform(col(key), seed)
    result: Column = F
    for part, fraction in enumerate(fractions[:-1]):
        reached += fraction / total
        result = result.when(u < reached, part)
    return result.otherwise(len(fractions) - 1) if len(fractions) > 1 else F.lit(0)


def random_split(
    df: DataFrame, fractions: Sequence[float], key: str | None, seed: int | str
) -> list[DataFrame]:
    """Disjoint frames that together hold every row."""
    if key is None:
        return df.randomSplit([float(f) for f in fractions], seed=int(seed))
    parted = df.withColumn("__part", split_column(key, fractions, seed))
    return [parted.filter(F.col("__part") == i).drop("__part") for i in range(len(fractions))]


def kfold(df: DataFrame, k: int, key: str, seed: int | str, out: str = "fold") -> DataFrame:
    """Add a fold number from 0 to k - 1."""
    return df.withColumn(out, F.floor(hash_uniform(col(key), seed) * k).cast("int"))


def stratified_column(
    df: DataFrame, label: str, fraction: float, key: str, seed: int | str, out: str = "is_test"
) -> DataFrame:
    """Flag exactly round(fraction * n) rows of each label, those with the smallest hashes.

    The last flagged row of each label is found by counting hash buckets, which are even by
    construction, and by ranking one bucket per label. So a label that most rows share is
    never gathered in one task, and the rows themselves are not shuffled while the labels are few
    enough for a broadcast; otherwise two joins by label and bucket or label shuffle them.
    """
    u = hash_uniform(col(key), seed)
    small = few_groups(df, [label])
    hashed = df.select(
        col(label).alias("__label"),
        col(key).alias("__key"),
        u.alias("__u"),
        F.floor(u * STRATUM_BUCKETS).cast("int").alias("__bucket"),
    )
    stratum = Window.partitionBy("__label")
    counts = hashed.groupBy("__label", "__bucket").agg(F.count("*").alias("__size"))
    wanted = F.round(F.sum("__size").over(stratum) * fraction).cast("bigint")
    upto = F.sum("__size").over(stratum.orderBy("__bucket"))
    edge = counts.select(
        F.col("__label").alias("__l"),
        F.col("__bucket").alias("__b"),
        (wanted - (upto - F.col("__size"))).alias("__rank"),
        "__size",
    ).filter((F.col("__rank") > 0) & (F.col("__rank") <= F.col("__size")))
    within = Window.partitionBy("__label", "__bucket").orderBy("__u", "__key")
    last = (
        hashed.join(
            broadcast_if(small, edge),
            F.col("__label").eqNullSafe(F.col("__l")) & (F.col("__bucket") == F.col("__b")),
        )
        .withColumn("__n", F.row_number().over(within))
        .filter(F.col("__n") == F.col("__rank"))
        .select("__l", F.struct("__u", "__key").alias("__last"))
    )
    own = F.struct(u.alias("__u"), col(key).alias("__key"))
    flagged = df.join(broadcast_if(small, last), col(label).eqNullSafe(F.col("__l")), "left")
    return flagged.select(
        *[col(c) for c in df.columns],
        F.coalesce(own <= F.col("__last"), F.lit(False)).alias(out),
    )


def stratified_split(
    df: DataFrame, label: str, fraction: float, key: str, seed: int | str
) -> tuple[DataFrame, DataFrame]:
    """Train and test frames; the test frame holds round(fraction * n) rows of each label."""
    flagged = stratified_column(df, label, fraction, key, seed, "__test")
    return (
        flagged.filter(~F.col("__test")).drop("__test"),
        flagged.filter(F.col("__test")).drop("__test"),
    )
