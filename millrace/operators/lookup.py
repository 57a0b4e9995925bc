"""Lookups in reference tables and band tables, and the imputations that use them.

A band table has the columns `lo`, `hi` (null: no upper end), a value, and any grouping
columns. Reference tables are expected to be small, and that is checked before they are
broadcast; larger ones take another way to the same result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, field, present
from millrace.functions.hashing import hash_uniform
from millrace.operators.order_statistics import bucketed
from millrace.operators.sizes import MAX_ROWS, broadcast_if, fits_broadcast
from millrace.sources.scratch import written

MAX_SCANNED_BANDS = 64  # bands that are compared one by one with every row
SALTS = 8  # parts of a bucket's rows
ROWS_PER_TASK = 1 << 18  # rows of both sides of a large join that one task sorts, about


def join_reference(
    df: DataFrame, ref: DataFrame, on: tuple[str, str], max_rows: int = MAX_ROWS
) -> DataFrame:
    """Full outer join with a reference table on one key per side; both keys are kept.

    The result has the columns of `df` and then those of `ref`, also where both have a name. A
    full outer join cannot broadcast, and shuffling by a key of few values puts most rows into
    few tasks. Here rows are matched with a left join, and the reference rows that no row
    matches are appended: their keys are found by a semi join that is reduced map-side. A
    reference of at most `max_rows` rows is broadcast, so rows are matched where they lie; for
    a larger one see `_joined_by_parts`. Rows without a key take no part in the joins.
    """
    left, right = on
    small = fits_broadcast(ref, max_rows)
    names = [f"__ref_{i}" for i in range(len(ref.columns))]
    side = ref.toDF(*names)
    key = names[ref.columns.index(right)]
    both = [*df.columns, *ref.columns]
    keyed = df.filter(col(left).isNotNull())
    apart = df.filter(col(left).isNull()).select("*", *_nulls(side))
    if not small:
        matched, unmatched = _joined_by_parts(keyed, left, side, key)
        return matched.union(apart).union(unmatched.select(*_nulls(df), *names)).toDF(*both)
    matched = keyed.join(F.broadcast(side), col(left) == col(key), "left")
    seen = (
        keyed.select(col(left).alias("__key"))
        .join(F.broadcast(side.select(key)), F.col("__key") == col(key), "left_semi")
        .distinct()
    )
    unmatched = side.join(seen, col(key) == F.col("__key"), "left_anti").select(*_nulls(df), *names)
    return matched.union(apart).union(unmatched).toDF(*both)


def _joined_by_parts(keyed: DataFrame, left: str, side: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with the rows of `side` they match, and the rows of `side` that none matches.

    The rows of each key are counted first, in a narrow table that is written. Their number says
    into how many parts both sides are dealt, so that a task sorts about `ROWS_PER_TASK` rows
    however large the tables are. A key with more rows than that is dealt out once more,
    over as many salts as it needs; its rows in `side` are repeated for each salt. Where `side`
    itself has such a key, the rows that none matches are found by a join that Spark can split.
    """
    without, side = side.filter(col(key).isNull()), side.filter(col(key).isNotNull())
    counted = keyed.groupBy(col(left).alias("__key")).agg(F.count("*").alias("__n"))
    counted = written(counted, "reference-keys")
    of_side = side.groupBy(key).agg(F.count("*").alias("__n"))
    (n, most), (n_side, most_side) = (
        c.agg(F.coalesce(F.sum("__n"), F.lit(0)), F.coalesce(F.max("__n"), F.lit(0))).first() for c in (counted, of_side)
    )
    parts = max(1, math.ceil((n + n_side) / ROWS_PER_TASK))
    refs, seen = side.repartition(parts, key), counted.select("__key")
    if most_side <= ROWS_PER_TASK:
        unmatched = refs.join(seen.repartition(parts, "__key"), col(key) == F.col("__key"), "left_anti").union(without)
    else:
        unmatched = side.join(seen, col(key) == F.col("__key"), "left_anti").union(without)
    if most <= ROWS_PER_TASK:
        return keyed.repartition(parts, col(left)).join(refs, col(left) == col(key), "left"), unmatched
    salts = F.ceil(F.col("__n") / ROWS_PER_TASK).cast("int")
    frequent = F.broadcast(counted.where(F.col("__n") > ROWS_PER_TASK).select("__key", salts.alias("__salts")))
    salts = F.coalesce("__salts", F.lit(1))
    salt = F.pmod(F.monotonically_increasing_id(), salts).cast("int").alias("__row_salt")
    rows = keyed.join(frequent, col(left) == F.col("__key"), "left").select(*[col(c) for c in keyed.columns], salt)
    refs = side.join(frequent, col(key) == F.col("__key"), "left").select(
        *side.columns, F.explode(F.sequence(F.lit(0), salts - 1)).alias("__salt")
    )
    met = (col(left) == col(key)) & (F.col("__row_salt") == F.col("__salt"))
    dealt = rows.repartition(parts, col(left), "__row_salt").join(refs.repartition(parts, key, "__salt"), met, "left")
    return dealt.drop("__row_salt", "__salt"), unmatched


def _nulls(df: DataFrame) -> list[Column]:
    """A null in the place of every column."""
    return [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema]


def range_lookup(
    df: DataFrame,
    bands: DataFrame,
    x: str,
    value: str = "rate",
    by: Sequence[str] = (),
    out: str | None = None,
    max_scanned: int = MAX_SCANNED_BANDS,
) -> DataFrame:
    """Add the value of the band that holds `x` (ends included); null if there is none.

    `by` columns must be equal on both sides. Bands of a group are taken not to overlap; a
    row in several gets one output row for each. A few bands are broadcast and compared one
    by one. Many are sorted into buckets: the bounds are up to 4,095 of the bands' own lower
    ends, within their groups, so that buckets hold equally many bands, and a band is in every
    bucket it reaches into. Rows meet bands by bucket and salt, which spreads a frequent value
    over several tasks; rows without a value or a group take no part.
    """
    out = out or value
    left = [c for c in df.columns if c != out]
    names = {b: f"__band_{i}" for i, b in enumerate(by)}
    side = bands.select(
        *[col(b).alias(n) for b, n in names.items()],
        F.col("lo").alias("__lo"),
        F.col("hi").alias("__hi"),
        col(value).alias("__value"),
    )
    at = present(df, x)
    inside = (at >= F.col("__lo")) & (F.col("__hi").isNull() | (at <= F.col("__hi")))
    for b, n in names.items():
        inside = inside & (col(b) == F.col(n))
    if fits_broadcast(side, max_scanned):
        joined = df.join(F.broadcast(side), inside, "left")
        return joined.select(*[col(c) for c in left], F.col("__value").alias(out))
    known = reduce(and_, [col(b).isNotNull() for b in by], at.isNotNull())
    ends = side.select(
        "*",
        F.struct(*names.values(), F.col("__lo").cast("double").alias("x")).alias("__from"),
        F.struct(
            *names.values(), F.coalesce(F.col("__hi").cast("double"), F.lit(float("inf"))).alias("x")
        ).alias("__to"),
    )
    keyed = df.filter(known).select(
        "*",
        F.struct(*[col(b).alias(n) for b, n in names.items()], at.cast("double").alias("x")).alias("__at"),
        F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("__row_salt"),
    )
    spread = (
        bucketed(bucketed(ends, "__from", ends, "__from", "__first"), "__to", ends, "__from", "__last")
        .withColumn("__bucket", F.explode(F.sequence("__first", "__last")))
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    rows = bucketed(keyed, "__at", ends, "__from", "__row_bucket")
    met = (F.col("__row_bucket") == F.col("__bucket")) & (F.col("__row_salt") == F.col("__salt"))
    joined = rows.join(spread, met & inside, "left")
    found = joined.select(*[col(c) for c in left], F.col("__value").alias(out))
    none = F.lit(None).cast(side.schema["__value"].dataType).alias(out)
    return found.union(df.filter(~known).select(*[col(c) for c in left], none))


def scale_rates(bands: DataFrame, ratio: float | Column, value: str = "rate") -> DataFrame:
    """A band table with its values multiplied."""
    factor = ratio if isinstance(ratio, Column) else F.lit(ratio)
    return bands.withColumn(value, col(value) * factor)


def rates_by_group(
    bands: DataFrame, by: str, ratios: Mapping[object, float], value: str = "rate"
) -> DataFrame:
    """One copy of the bands per group, each with the group's ratio applied to the values."""
    pairs = [F.struct(F.lit(g).alias("g"), F.lit(float(r)).alias("r")) for g, r in ratios.items()]
    grouped = bands.withColumn("__group", F.explode(F.array(*pairs)))
    return grouped.select(
        F.col("__group.g").alias(by),
        *[
            (col(c) * F.col("__group.r")).alias(c) if c == value else col(c)
            for c in bands.columns
        ],
    )


def impute_bernoulli(
    df: DataFrame,
    name: str,
    bands: DataFrame,
    x: str,
    key: str,
    seed: int | str,
    by: Sequence[str] = (),
    value: str = "rate",
) -> DataFrame:
    """A missing flag becomes 1 with the probability of the row's band, and 0 otherwise.

    The draw depends on the row's key and the seed only. Without a band it stays missing.
    """
    looked_up = range_lookup(df, bands, x, value, by, out="__rate")
    draw = F.when(hash_uniform(col(key), seed) <= F.col("__rate"), 1).when(
        F.col("__rate").isNotNull(), 0
    )
    filled = F.coalesce(present(df, name), draw.cast(field(df, name).dataType))
    return looked_up.select(*[filled.alias(c) if c == name else col(c) for c in df.columns])


def mean_of_rates(
    df: DataFrame, name: str, sources: Sequence[tuple[DataFrame, str, Sequence[str]]]
) -> DataFrame:
    """Set a column to the mean of the rates that several band tables give for the row.

    A source is (bands, column looked up, grouping columns). A row that one source has no
    rate for gets null.
    """
    outs = [f"__rate_{i}" for i in range(len(sources))]
    looked_up = df
    for (bands, x, by), out in zip(sources, outs):
        looked_up = range_lookup(looked_up, bands, x, by=by, out=out)
    total = sum((F.col(o) for o in outs[1:]), F.col(outs[0]))
    kept = [col(c) for c in df.columns if c != name]
    return looked_up.select(*kept, (total / len(outs)).alias(name))
