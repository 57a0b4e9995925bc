"""Whole-table statistics that later steps of the same plan use.

A fitted statistic reaches the rows as an uncorrelated scalar subquery: one aggregate with
map-side partials, whose single row Spark inserts into the outer plan when it runs. There is
no join, no collect in between, and the frame stays lazy.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import col

STATS = "__stats"


def with_stats(df: DataFrame, stats: DataFrame, name: str = STATS) -> DataFrame:
    """Add the only row of `stats` to every row of `df`, as one struct column."""
    return df.withColumn(name, stats.select(F.struct(*[col(c) for c in stats.columns])).scalar())


def stat(name: str, holder: str = STATS) -> Column:
    """A statistic put there by `with_stats`."""
    return F.col(holder).getField(name)


def mode_stats(df: DataFrame, values: Mapping[str, tuple[Column, T.DataType]]) -> DataFrame:
    """One row with the most frequent non-null value of each expression, lowest on ties.

    The values are counted under a hash partitioning, combined map-side first, and only then
    reduced to the best pair. So a column of many distinct values, which would fill one task
    as the state of `mode()`, is spread over the cluster. One scan serves all columns; those
    of one type share a column of the counted table.
    """
    types = {t.simpleString(): t for _, t in values.values()}
    slots = {name: f"v{i}" for i, name in enumerate(types)}
    numbers = {n: i for i, n in enumerate(values)}

    def entry(name: str) -> Column:
        expr, own = values[name]
        typed = [
            (expr if t == own.simpleString() else F.lit(None)).cast(types[t]).alias(slot)
            for t, slot in slots.items()
        ]
        return F.struct(F.lit(numbers[name]).alias("entry"), *typed)

    counted = (
        df.select(F.explode(F.array(*[entry(n) for n in values])).alias("e"))
        .select("e.*")
        .filter(reduce(or_, [F.col(s).isNotNull() for s in slots.values()]))
        .groupBy("entry", *slots.values())
        .agg(F.count("*").alias("n"))
    )

    def best(name: str) -> Column:
        value = F.col(slots[values[name][1].simpleString()])
        pair = F.struct((-F.col("n")).alias("rank"), value.alias("value"))
        return F.min(F.when(F.col("entry") == numbers[name], pair)).getField("value")

    return counted.agg(*[best(n).alias(n) for n in values])
