"""Codes of categories: one counted table for any number of columns.

The values of all columns are unpivoted and counted under one hash partitioning, combined
map-side. That narrow table of distinct values is written once; codes are running counts over
it, bucket by bucket, and the numbers that size checks need come from it as well. So the source
is scanned once however many columns there are, and no value goes to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import col, field
from millrace.operators.order_statistics import running_total
from millrace.operators.sizes import MAX_BYTES, MAX_ROWS
from millrace.sources.scratch import scratch_path

SALTS = 8  # parts of a value's rows in a join with a large code table


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Codes:
    """Rows (entry, value columns by type, n, code) of all columns, and how many each has."""

    table: DataFrame
    slots: Mapping[int, str]
    sizes: Mapping[int, int]
    lengths: Mapping[int, int]

    def side(self, entry: int, value: str, code: str) -> DataFrame:
        """The code table of one column."""
        rows = self.table.where(F.col("entry") == entry)
        return rows.select(F.col(self.slots[entry]).alias(value), F.col("code").alias(code))


def category_codes(df: DataFrame, cols: Sequence[str], by_frequency: bool = False) -> Codes:
    """Number the distinct non-null values of each column from 0: in ascending order, or by
    falling frequency with the lower value first on ties."""
    types = {field(df, c).dataType.simpleString(): field(df, c).dataType for c in cols}
    slot = {name: f"v{i}" for i, name in enumerate(types)}
    own = {i: slot[field(df, c).dataType.simpleString()] for i, c in enumerate(cols)}

    def entry(i: int, c: str) -> Column:
        values = [(col(c) if s == own[i] else F.lit(None)).cast(types[t]).alias(s) for t, s in slot.items()]
        return F.struct(F.lit(i).alias("entry"), *values)

    counted = (
        df.select(F.explode(F.array(*[entry(i, c) for i, c in enumerate(cols)])).alias("e"))
        .select("e.*")
        .filter(reduce(or_, [F.col(s).isNotNull() for s in slot.values()]))
        .groupBy("entry", *slot.values())
        .agg(F.count("*").alias("n"))
    )
    counted = _stored(counted, "category-counts")
    text = F.octet_length(F.to_json(F.struct(*slot.values())))
    found = {r["entry"]: r for r in counted.groupBy("entry").agg(F.count("*").alias("rows"), F.sum(text).alias("bytes")).collect()}
    sizes = {i: found[i]["rows"] if i in found else 0 for i in range(len(cols))}
    lengths = {i: found[i]["bytes"] if i in found else 0 for i in range(len(cols))}
    rank = [(-F.col("n")).alias("rank")] if by_frequency else []
    order = F.struct("entry", *rank, *slot.values())
    if max(sizes.values(), default=0) <= MAX_ROWS:  # a column's few values may be ranked by one task
        place = F.row_number().over(Window.partitionBy("entry").orderBy(order)) - 1
        ranked = counted.select("entry", *slot.values(), "n", place.cast("bigint").alias("code"))
        return Codes(ranked, own, sizes, lengths)
    before = [0, *accumulate(sizes[i] for i in range(len(cols)))]
    ordered = counted.select("*", order.alias("order"), F.lit(1).cast("bigint").alias("one"))
    ranked = running_total(ordered, "order", {"place": "one"})
    first = F.lit(before).cast("array<bigint>")[F.col("entry")]
    table = ranked.select("entry", *slot.values(), "n", (F.col("place") - first).alias("code"))
    return Codes(_stored(table, "category-codes"), own, sizes, lengths)


def attach(df: DataFrame, side: DataFrame, name: str, out: str, small: bool) -> DataFrame:
    """Left join of a code table (__value, `out`) on its value.

    A large code table is joined by value and salt, so that the rows of a frequent value are
    spread over several tasks; rows without a value stay out of the join.
    """
    if small:
        return df.join(F.broadcast(side), col(name) == F.col("__value"), "left").drop("__value")
    salted = side.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = df.filter(col(name).isNotNull()).withColumn(
        "__row_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    )
    met = (col(name) == F.col("__value")) & (F.col("__row_salt") == F.col("__salt"))
    coded = rows.join(salted, met, "left").drop("__value", "__salt", "__row_salt")
    none = F.lit(None).cast(side.schema[out].dataType).alias(out)
    return coded.union(df.filter(col(name).isNull()).select("*", none))


def attach_codes(df: DataFrame, codes: Codes, cols: Sequence[str], suffix: str, limit: int = MAX_ROWS) -> DataFrame:
    """Add the code of every column's value; null for a value without one."""
    for i, c in enumerate(cols):
        small = codes.sizes[i] <= limit and codes.lengths[i] <= MAX_BYTES
        df = attach(df, codes.side(i, "__value", c + suffix), c, c + suffix, small)
    return df


def with_string_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns alone, as text."""
    return df.select(*[col(c).cast(T.StringType()).alias(c) for c in cols])
