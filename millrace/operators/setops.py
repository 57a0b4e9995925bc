"""Union, distinct values, and deduplication by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name; an absent column is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _ordered(df: DataFrame, name: str) -> Column | None:
    """What stands for a column that cannot be compared; none for those that can."""
    kind = df.schema[name].dataType.simpleString()
    return F.to_json(F.struct(col(name))) if "map<" in kind or "variant" in kind else None


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[col(c) for c in cols]).distinct()


def dedup_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep the first row of each key by an explicit order (then by the other columns).

    The first row is the minimum of a struct, so every task reduces its rows to one per key
    before the shuffle: copies of one key never gather in one task as they do in a window. The
    reduction sorts a task's rows by key, as structs with texts do not fit a hash aggregate.
    Columns without an order, such as maps, take part in it as JSON text.
    """
    rest = [c for c in df.columns if c not in set(keys) | set(order_by)]
    own = F.struct(*[col(c) for c in [*order_by, *rest] if c not in keys])
    orders = [_ordered(df, c) for c in [*order_by, *rest] if c not in keys]
    if all(o is None for o in orders):
        first = F.min(own)
    else:
        names = [c for c in [*order_by, *rest] if c not in keys]
        order = F.struct(*[col(c) if o is None else o for c, o in zip(names, orders)])
        first = F.min_by(own, order)
    first = df.groupBy(*[col(k) for k in keys]).agg(first.alias("__first"))
    return first.select(
        *[col(c) if c in keys else F.col("__first").getField(c).alias(c) for c in df.columns]
    )
