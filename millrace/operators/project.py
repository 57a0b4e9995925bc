"""Projections and filters. Each is one narrow transformation; none starts a job."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import STRINGS, col, columns_of, is_missing


def replace_columns(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """Replace columns in place and append new ones, all in one projection."""
    kept = [new[c].alias(c) if c in new else col(c) for c in df.columns]
    return df.select(*kept, *[e.alias(c) for c, e in new.items() if c not in df.columns])


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[col(c) for c in cols])


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[col(c) for c in df.columns if c not in set(cols)])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by exact name; any character may occur in either name."""
    return df.select(*[col(c).alias(names.get(c, c)) for c in df.columns])


def cast_where(
    df: DataFrame, from_types: type | Sequence[type], to: str | T.DataType, lenient: bool = False
) -> DataFrame:
    """Cast every column of the given types; `lenient` turns unreadable values into null."""
    cast = Column.try_cast if lenient else Column.cast
    return replace_columns(df, {c: cast(col(c), to) for c in columns_of(df, from_types)})


def trim_strings(df: DataFrame) -> DataFrame:
    return replace_columns(df, {c: F.trim(col(c)) for c in columns_of(df, STRINGS)})


def copy_column(df: DataFrame, source: str, *targets: str) -> DataFrame:
    return replace_columns(df, {t: col(source) for t in targets})


def null_column(df: DataFrame, name: str, data_type: str | T.DataType = "double") -> DataFrame:
    return replace_columns(df, {name: F.lit(None).cast(data_type)})


def conditional(
    df: DataFrame, name: str, cases: Sequence[tuple[Column, object]], otherwise: object = None
) -> DataFrame:
    """Set a column to the value of the first case that holds."""
    result: Column = F
    for test, value in cases:
        result = result.when(test, value)
    return replace_columns(df, {name: result.otherwise(otherwise)})


def combine_columns(
    left: DataFrame, right: DataFrame, key: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Put the columns of two frames side by side, matching rows by key.

    Frames have no row order, so the key takes the place of the position. Where both sides
    come from one frame, add the columns to it instead: that needs no shuffle.
    """
    return left.join(right, list(key), how)


def features_and_label(
    df: DataFrame, label: str, drop: Sequence[str] = ()
) -> tuple[list[str], str]:
    """The feature columns and the label column of a training frame."""
    return [c for c in df.columns if c != label and c not in set(drop)], label


def filter_equal(df: DataFrame, name: str, value: object) -> DataFrame:
    return df.filter(col(name) == value)


def filter_between(df: DataFrame, name: str, lo: object, hi: object) -> DataFrame:
    return df.filter(col(name).between(lo, hi))


def filter_contains(df: DataFrame, name: str, text: str, regex: bool = False) -> DataFrame:
    return df.filter(col(name).rlike(text) if regex else col(name).contains(text))


def filter_not_null(df: DataFrame, *names: str) -> DataFrame:
    for name in names:
        df = df.filter(col(name).isNotNull())
    return df


def drop_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Keep the rows without null or NaN in the given columns (default: all)."""
    tests = [~is_missing(df, name) for name in (df.columns if cols is None else cols)]
    return df.filter(reduce(and_, tests)) if tests else df


def drop_flagged(df: DataFrame, mask: Column) -> DataFrame:
    """Remove the rows whose mask is true; an unknown mask keeps its row."""
    return df.filter(~F.coalesce(mask, F.lit(False)))


def first_n(df: DataFrame, order_by: Sequence[str | Column], n: int) -> DataFrame:
    """First n rows by an explicit, unique order (a per-task top-n, then a merge)."""
    keys = [col(c) if isinstance(c, str) else c for c in order_by]
    return df.orderBy(*keys).limit(n)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def apply_columns(
    df: DataFrame, cols: Sequence[str], f: Callable[[Column], Column], name: str = "{0}"
) -> DataFrame:
    """Apply one column function to many columns; `name` forms the output names."""
    return replace_columns(df, {name.format(c): f(col(c)) for c in cols})
